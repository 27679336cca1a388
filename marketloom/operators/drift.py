"""Drifting record schemas: tagged-union inference over files of JSON records.

The schemas of a feed's files are fused path by path. A path keeps every kind it was seen with
(a tagged union) rather than being widened; values of one path come out in typed branches
(``figures``, ``texts``, ``truths``, ``nested``) besides a canonical conversion, and every appearing or vanishing
path, rename and change of kind is reported against the file before it.

A rename is one path going and another coming in the same file with the same content: equal
canonical values on most of the company rows that both files carry, or the same part (symbol,
period, load time), told by the shape of the values rather than by name.

Defined results: records that aren't complete JSON objects (null, empty, cut off) count for
nothing, and files without any valid record don't exist; nulls carry no kind, and a path whose
values are all null keeps its last kind; repeated records change nothing but counts.

Scale: records are parsed once, into cells that are written with the columns a query needs. All
is keyed by (feed, file) or finer; going and coming fields meet on (feed, file, row, value), so
only equal values meet and a large file is spread over its rows. Only the list of distinct files
and paths is ordered per feed, so one feed may hold most of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketloom.session import written
from marketloom.functions.fundamentals import MONTHS, period_of, plain_number, squeeze

FILE = ["feed_id", "file_no"]
KINDS = ("number", "text", "boolean", "object", "list")
#: Share of the compared rows on which two paths must agree, and of values that show a part's shape.
AGREE, SHAPE = 0.5, 0.8
#: The unit of amounts that plain figures have too.
UNIT = "cr"


def _kind(json: Column) -> Column:
    """The kind of a JSON value by its first character; null for null."""
    c = F.substring(json, 1, 1)
    return F.when(c == '"', "text").when(c == "{", "object").when(c == "[", "list").when(c.isin("t", "f"), "boolean").when(c != "n", "number")


def _one_value(v: Column) -> Column:
    """Whether a list or object stands for one plain value: a list of one item, an amount in the unit of plain figures."""
    listed = F.try_variant_get(v, "$[0]", "string").isNotNull() & F.try_variant_get(v, "$[1]", "variant").isNull()
    unit = F.coalesce(F.lower(F.trim(F.try_variant_get(v, "$.unit", "string"))), F.lit(UNIT))
    return listed | (F.try_variant_get(v, "$.amount", "string").isNotNull() & (unit == UNIT))


def entries(files: DataFrame) -> DataFrame:
    """One row per path of each valid record: the value as a variant, as JSON, and its kind."""
    # parsed once: the filter keeps the optimiser from repeating the parser for each use
    parsed = files.select(*FILE, "row_no", "table_name", F.try_parse_json("payload").alias("v")).where(F.col("v").isNotNull())
    records = parsed.where(F.schema_of_variant("v").startswith("OBJECT"))
    # explode_outer, as explode would have the map built once more to filter empty ones
    e = records.select(*FILE, "row_no", "table_name", F.explode_outer(F.expr("cast(v AS map<string, variant>)")).alias("field", "x")).where(F.col("field").isNotNull())
    # a null member has a null variant; neither has a kind
    return e.withColumn("json", F.to_json("x")).withColumn("kind", _kind(F.col("json")))


def cells(files: DataFrame) -> DataFrame:
    """One row per path of each valid record: its kind, canonical value, figure, and the parts it could be."""
    e = entries(files)
    several = F.col("kind").isin("object", "list")
    x = F.col("x")
    inner = F.coalesce(F.try_variant_get(x, "$.amount", "string"), F.try_variant_get(x, "$[0]", "string"), F.col("json"))
    plain = F.trim(F.when(several, inner).otherwise(F.try_variant_get(x, "$", "string")))
    c = e.select(*FILE, "row_no", "table_name", "field", "kind", plain.alias("plain"), F.when(several, F.col("json")).alias("nested"), F.when(several, F.coalesce(_one_value(x), F.lit(False))).otherwise(True).alias("single"))
    # staged, so that nothing is computed twice and each stage's code stays small enough to be compiled
    keep = [*FILE, "row_no", "table_name", "field", "kind", "plain", "nested", "single"]
    text, number = F.col("kind") == "text", F.col("kind") == "number"
    c = c.select(
        *keep,
        F.lower("plain").alias("_low"),
        F.when(text, F.upper(squeeze(F.col("plain")))).alias("_up"),
        F.when(F.col("plain").rlike("^(?:19|20)[0-9]{2}(?:0[1-9]|1[0-2])$"), F.col("plain")).alias("_yyyymm"),
        F.when(number, F.col("plain").try_cast("decimal(20,0)").cast("long")).alias("_whole"),
        F.regexp_replace("plain", r"\s*\([A-Za-z*]+\)$", "").alias("_bare"),
        F.when(text & F.col("plain").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:"), F.col("plain")).alias("_stamp"),
        (text & F.col("plain").rlike(r"^[A-Z]{2}[A-Z0-9&.\-]{0,18}$")).alias("ticker"),
    )
    c = c.select(*keep, "ticker", "_low", "_yyyymm", "_whole", "_stamp", plain_number(F.col("_bare")).alias("_number"), period_of(F.col("_up")).alias("_period"))
    by_number = F.concat(F.try_element_at(F.array(*(F.lit(m) for m in MONTHS)), F.substring("_yyyymm", 5, 2).try_cast("int")), F.lit(" "), F.substring("_yyyymm", 1, 4))
    whole = F.col("_whole")
    epoch = F.when(whole.between(600_000_000, 9_999_999_999), whole * 1_000_000).when(whole.between(600_000_000_000, 9_999_999_999_999), whole * 1_000).when(whole.between(600_000_000_000_000, 9_999_999_999_999_999), whole)
    c = c.select(
        *keep,
        "ticker",
        F.when(F.col("_low").isin("true", "yes", "y"), 1.0).when(F.col("_low").isin("false", "no", "n"), 0.0).otherwise(F.col("_number").try_cast("double")).alias("figure"),
        F.when(text, F.col("_period")).otherwise(by_number).alias("period"),
        F.coalesce(F.unix_micros(F.col("_stamp").try_cast("timestamp")), epoch).alias("instant"),
    )
    canonical = F.coalesce(F.col("period"), F.col("instant").cast("string"), F.col("figure").cast("string"), F.col("plain"))
    return c.withColumn("canonical", F.when(F.col("kind").isNotNull(), canonical))


def paths(c: DataFrame) -> DataFrame:
    """One row per (feed, file, field): how often each kind occurs, and the part its values show."""
    counts = [F.count_if(F.col("kind") == k).alias(k) for k in KINDS]
    g = c.groupBy(*FILE, "field").agg(
        *counts,
        F.count("kind").alias("n"),
        F.count("period").alias("n_period"),
        F.count("instant").alias("n_instant"),
        F.count_if("ticker").alias("n_ticker"),
    )
    most = F.greatest(*KINDS)
    enough = lambda x: F.col(x) >= F.col("n") * SHAPE
    return (
        g.withColumn("top", F.when(most > 0, F.array_compact(F.array(*(F.when(F.col(k) == most, F.lit(k)) for k in KINDS)))))
        .withColumn(
            "part",
            F.when(F.col("n") > 0, F.when(enough("n_period"), "period").when(enough("n_instant"), "time").when(enough("n_ticker") & (F.col("n_ticker") > 0), "symbol")),
        )
        .select(*FILE, "field", "top", "part", "n", *KINDS)
    )


def kind_counts(files: DataFrame) -> DataFrame:
    """(feed_id, file_no, field, kind, n): how many values of a field are of a kind; fields that are null throughout don't come out."""
    e = entries(files).where(F.col("kind").isNotNull())
    return e.groupBy(*FILE, "field", "kind").agg(F.count(F.lit(1)).alias("n"))


def kinds_by_file(p: DataFrame) -> DataFrame:
    """paths with prev_file, next_file, the kind of each field in the file, and the kind it had before."""
    order = Window.partitionBy("feed_id").orderBy("file_no")
    files = p.select(*FILE).distinct().withColumn("prev_file", F.lag("file_no").over(order)).withColumn("next_file", F.lead("file_no").over(order))
    by_field = Window.partitionBy("feed_id", "field").orderBy("file_no")
    before = F.last("one", ignorenulls=True).over(by_field.rowsBetween(Window.unboundedPreceding, -1))
    # a tie goes to the kind the field had, else to the first in the order of KINDS
    k = p.withColumn("one", F.element_at("top", 1)).withColumn("held", before)
    k = k.withColumn("own", F.when(F.array_contains("top", F.col("held")), F.col("held")).otherwise(F.col("one")))
    k = k.withColumn("kind", F.last("own", ignorenulls=True).over(by_field.rowsBetween(Window.unboundedPreceding, 0)))
    return k.join(files, FILE).select(*FILE, "prev_file", "next_file", "field", "kind", "part", *KINDS, "n")


def _row_keys(c: DataFrame, k: DataFrame) -> DataFrame:
    """(feed, file, row_no, key): symbol and period of each record, found by the shape of the values."""
    parts = k.where(F.col("part").isin("symbol", "period")).select(*FILE, "field", "part")
    hint = F.lower("field").rlike("symbol|ticker|scrip|period").cast("int")
    best = parts.groupBy(*FILE, "part").agg(F.max(F.struct(hint.alias("h"), F.col("field").alias("f"))).alias("b")).select(*FILE, F.col("b.f").alias("field"), "part")
    named = c.join(best, [*FILE, "field"])
    return (
        named.groupBy(*FILE, "row_no")
        .agg(F.max(F.when(F.col("part") == "symbol", F.col("canonical"))).alias("s"), F.max(F.when(F.col("part") == "period", F.col("canonical"))).alias("p"))
        .where(F.col("s").isNotNull())
        .select(*FILE, "row_no", F.concat_ws("|", "s", F.coalesce("p", F.lit("")).alias("p")).alias("key"))
    )


def renames(c: DataFrame, k: DataFrame) -> DataFrame:
    """(feed_id, file_no, field_before, field_after): best mutual matches of going and coming fields.

    Candidates are the pairs with an equal value in a row that both files carry; how many rows
    two fields share is counted for candidates only.
    """
    by_field = Window.partitionBy("feed_id", "field").orderBy("file_no")
    k = k.withColumn("came", F.col("prev_file").isNotNull() & ~F.lag("file_no").over(by_field).eqNullSafe(F.col("prev_file"))).withColumn(
        "goes", F.col("next_file").isNotNull() & ~F.lead("file_no").over(by_field).eqNullSafe(F.col("next_file")))
    moved = k.where("came OR goes").select(*FILE, "next_file", "field", "part", "came", "goes")
    came = moved.where("came").select(*FILE, F.col("field").alias("field_after"), F.col("part").alias("part_after"))
    went = moved.where("goes").select("feed_id", F.col("next_file").alias("file_no"), F.col("field").alias("field_before"), F.col("part").alias("part_before"))
    by_part = came.where("part_after IS NOT NULL").join(went.withColumn("part_after", F.col("part_before")), [*FILE, "part_after"]).select(*FILE, "field_before", "field_after", F.lit(2.0).alias("share"), F.lit(1).alias("m"))
    # values of the moved fields, and those that name a row, where a file has both going and coming fields without a part
    both = came.where("part_after IS NULL").select(*FILE).distinct().join(went.where("part_before IS NULL").select(*FILE).distinct(), FILE)
    pairs = both.join(k.select(*FILE, "prev_file").distinct(), FILE)
    concerned = pairs.select(*FILE).unionByName(pairs.select("feed_id", F.col("prev_file").alias("file_no"))).distinct()
    wanted = k.join(concerned, FILE, "left_semi").where(F.col("part").isin("symbol", "period") | (F.col("part").isNull() & (F.col("came") | F.col("goes")))).select(*FILE, "next_file", "field", "part", "came", "goes")
    values = written(c.where(F.col("kind").isNotNull()).select(*FILE, "row_no", "field", "canonical").join(wanted, [*FILE, "field"]), "moved")
    keyed = values.where("part IS NULL").join(_row_keys(values.select(*FILE, "row_no", "field", "canonical"), k), [*FILE, "row_no"])
    before = keyed.where("goes").select("feed_id", F.col("next_file").alias("file_no"), "key", F.col("field").alias("field_before"), "canonical")
    after = keyed.where("came").select(*FILE, "key", F.col("field").alias("field_after"), "canonical")
    equal = before.join(after, [*FILE, "key", "canonical"]).groupBy(*FILE, "field_before", "field_after").agg(F.count(F.lit(1)).alias("m"))
    shared = before.drop("canonical").join(equal, [*FILE, "field_before"]).join(after.drop("canonical"), [*FILE, "field_after", "key"])
    by_value = (
        shared.groupBy(*FILE, "field_before", "field_after")
        .agg(F.first("m").alias("m"), F.count(F.lit(1)).alias("n"))
        .where(F.col("m") >= F.col("n") * AGREE)
        .select(*FILE, "field_before", "field_after", (F.col("m") / F.col("n")).alias("share"), F.col("m").cast("int").alias("m"))
    )
    found = by_part.unionByName(by_value)
    rank = lambda x, y: F.row_number().over(Window.partitionBy(*FILE, x).orderBy(F.desc("share"), F.desc("m"), y))
    return found.withColumn("i", rank("field_before", "field_after")).withColumn("j", rank("field_after", "field_before")).where((F.col("i") == 1) & (F.col("j") == 1)).select(*FILE, "field_before", "field_after")


def changes(k: DataFrame, renamed: DataFrame) -> DataFrame:
    """(feed_id, file_no, change, field_before, field_after), one row per change against the file before."""
    a = k.where(F.col("prev_file").isNotNull()).select(*FILE, F.col("field").alias("field_after"), F.col("kind").alias("kind_after"))
    b = k.where(F.col("next_file").isNotNull()).select("feed_id", F.col("next_file").alias("file_no"), F.col("field").alias("field_before"), F.col("kind").alias("kind_before"))
    link = a.select(*FILE, F.col("field_after").alias("field_before"), "field_after").join(b.select(*FILE, "field_before"), [*FILE, "field_before"])
    links = link.select(*FILE, "field_before", "field_after").withColumn("renamed", F.lit(False)).unionByName(renamed.withColumn("renamed", F.lit(True)))
    added = a.join(links.select(*FILE, "field_after"), [*FILE, "field_after"], "left_anti").select(*FILE, F.lit("added").alias("change"), F.lit("").alias("field_before"), "field_after")
    removed = b.join(links.select(*FILE, "field_before"), [*FILE, "field_before"], "left_anti").select(*FILE, F.lit("removed").alias("change"), "field_before", F.lit("").alias("field_after"))
    named = renamed.select(*FILE, F.lit("renamed").alias("change"), "field_before", "field_after")
    retyped = (
        links.join(a, [*FILE, "field_after"])
        .join(b, [*FILE, "field_before"])
        .where(F.col("kind_before") != F.col("kind_after"))
        .select(*FILE, F.lit("retyped").alias("change"), "field_before", "field_after")
    )
    return added.unionByName(removed).unionByName(named).unionByName(retyped)


#: Columns of a cell that finding changes takes.
_FOR_CHANGES = ["kind", "canonical", "period", "instant", "ticker"]


def infer(files: DataFrame, more: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(cells, kinds by file, renames) of the files; ``more`` names columns of cells that the caller needs."""
    names = dict.fromkeys([*_FOR_CHANGES, *more])
    c = written(cells(files).select(*FILE, "row_no", "table_name", "field", *names), "cells")
    k = written(kinds_by_file(paths(c)), "kinds")
    return c, k, written(renames(c, k), "renames")


def lineage(k: DataFrame, renamed: DataFrame) -> DataFrame:
    """(feed_id, file_no, field, origin): the name under which each field's content first appeared.

    A stretch of files that carry a field without a break, and not under a new name, is one node;
    only renames link nodes. Pointers are doubled over the nodes, each round written, so a chain
    of n renames takes log2(n) rounds.
    """
    by_field = Window.partitionBy("feed_id", "field").orderBy("file_no")
    new = renamed.select(*FILE, F.col("field_after").alias("field"), F.col("field_before").alias("was"))
    here = k.select(*FILE, "prev_file", "field").join(new, [*FILE, "field"], "left")
    begins = F.col("was").isNotNull() | F.col("prev_file").isNull() | ~F.lag("file_no").over(by_field).eqNullSafe(F.col("prev_file"))
    here = here.withColumn("since", F.last(F.when(begins, F.col("file_no")), ignorenulls=True).over(by_field.rowsBetween(Window.unboundedPreceding, 0)))
    here = written(here, "stretches")
    ends = here.select("feed_id", F.col("file_no").alias("prev_file"), F.col("field").alias("was"), F.col("since").alias("to_since"))
    nodes = here.where("since = file_no").join(ends, ["feed_id", "prev_file", "was"], "left")
    links = nodes.select("feed_id", "since", "field", F.coalesce("to_since", "since").alias("to_since"), F.when(F.col("to_since").isNotNull(), F.col("was")).otherwise(F.col("field")).alias("to_field"))
    while True:
        links = written(links, "links")
        far = links.select("feed_id", F.col("since").alias("to_since"), F.col("field").alias("to_field"), F.col("to_since").alias("s2"), F.col("to_field").alias("f2"))
        on = links.join(far, ["feed_id", "to_since", "to_field"])
        if on.where("s2 <> to_since OR f2 <> to_field").isEmpty():
            break
        links = on.select("feed_id", "since", "field", F.col("s2").alias("to_since"), F.col("f2").alias("to_field"))
    return here.join(links, ["feed_id", "since", "field"]).select(*FILE, "field", F.col("to_field").alias("origin"))


def consistent_rows(files: DataFrame) -> DataFrame:
    """One row per valid record: symbol, financial_period, ingested_at, and typed branches by original name.

    ``figures`` holds what converts to a number, ``texts`` what doesn't; a plain value is in one of them.
    ``nested`` holds the whole JSON of every list and object; one that doesn't stand for one plain value
    is there only. ``truths`` holds booleans, which are figures (1 and 0) too.
    """
    c, k, renamed = infer(files, ("single", "figure", "plain", "nested"))
    origin = lineage(k, renamed).join(k.select(*FILE, "field", "part"), [*FILE, "field"])
    v = c.where(F.col("kind").isNotNull()).join(origin, [*FILE, "field"])
    own = F.col("part").isNull()
    per_field = v.groupBy(*FILE, "row_no", "table_name", "origin").agg(
        F.first("part").alias("part"), F.max(F.when(F.col("single"), F.col("figure"))).alias("figure"), F.max(F.when(F.col("single"), F.col("plain"))).alias("plain"), F.max("canonical").alias("canonical"), F.max("instant").alias("instant"),
        F.max(F.when(F.col("kind") == "boolean", F.col("plain").try_cast("boolean"))).alias("truth"), F.max("nested").alias("nested"),
    )
    pair = lambda x: F.struct(F.col("origin"), F.col(x))
    return (
        per_field.groupBy(*FILE, "row_no", "table_name")
        .agg(
            F.max(F.when(F.col("part") == "symbol", F.col("canonical"))).alias("symbol"),
            F.max(F.when(F.col("part") == "period", F.col("canonical"))).alias("financial_period"),
            F.timestamp_micros(F.max(F.when(F.col("part") == "time", F.col("instant")))).alias("ingested_at"),
            F.map_from_entries(F.array_sort(F.collect_list(F.when(own & F.col("figure").isNotNull(), pair("figure"))))).alias("figures"),
            F.map_from_entries(F.array_sort(F.collect_list(F.when(own & F.col("figure").isNull() & F.col("plain").isNotNull(), pair("plain"))))).alias("texts"),
            F.map_from_entries(F.array_sort(F.collect_list(F.when(own & F.col("truth").isNotNull(), pair("truth"))))).alias("truths"),
            F.map_from_entries(F.array_sort(F.collect_list(F.when(own & F.col("nested").isNotNull(), pair("nested"))))).alias("nested"),
        )
    )


def unions(files: DataFrame) -> DataFrame:
    """The fused schema: per feed and original field each kind it takes, how often, and in which file it appeared."""
    _, k, renamed = infer(files)
    o = lineage(k, renamed).join(k.select(*FILE, "field", *KINDS), [*FILE, "field"])
    stacked = o.select(*FILE, "origin", F.expr(f"stack({len(KINDS)}, " + ", ".join(f"'{x}', {x}" for x in KINDS) + ") AS (kind, n)")).where("n > 0")
    return stacked.groupBy("feed_id", F.col("origin").alias("field"), "kind").agg(F.sum("n").alias("n_values"), F.min("file_no").alias("first_file"))
