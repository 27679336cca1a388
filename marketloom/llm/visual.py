"""One consistent form of texts that look the same.

DuckDB runs inside each Arrow partition: embedded SQL strips invisible characters by regular
expression, translates compatibility forms, spaces and look-alike letters, and composes accents
with ``nfc_normalize``. What a reader can tell apart stays apart: case, accents, digits,
superscripts, fractions, punctuation and the presence (and number) of spaces.

Defined results: a null text has a null form; an empty or blank one a blank form and is never
part of a pair; forms are idempotent.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.session import written

# Letters (and Roman numerals) of Greek, Cyrillic, Armenian, Cherokee, Lisu and Coptic by the Latin
# letter whose shape they have. Letters whose shape only resembles a Latin one (α γ ι κ υ, к, г, small capitals), other
# letters of the Latin script (ɑ ɡ ᴏ) and styled alphabets (bold, italic, script) can be told apart and stay as they are.
LOOK_ALIKES = {
    "A": "ΑАᎪꓮ", "B": "ΒВᏴꓐⲂ", "C": "СϹᏟⅭꓚⲤ", "D": "ᎠⅮꓓ", "E": "ΕЕᎬꓰ", "F": "Ϝꓝ", "G": "ԌᏀꓖ", "H": "ΗНᎻꓧⲎ", "I": "ΙІӀⅠꓲⲒ",
    "J": "ЈᎫͿꓙ", "K": "ΚКᏦꓗⲔ", "L": "ᏞⅬꓡ", "M": "ΜМᎷϺⅯꓟⲘ", "N": "ΝꓠⲚ", "O": "ΟОՕꓳⲞ", "P": "ΡРᏢꓑⲢ", "Q": "Ԛ", "R": "ᎡᏒꓣ",
    "S": "ЅՏᏚꓢ", "T": "ΤТᎢꓔⲦ", "U": "Սꓴ", "V": "ѴᏙⅤꓦ", "W": "ԜᎳᏔꓪ", "X": "ΧХⅩꓫⲬ", "Y": "ΥҮꓬⲨ", "Z": "ΖᏃꓜ",
    "a": "а", "c": "сϲⅽⲥ", "d": "ԁⅾ", "e": "е", "h": "һ", "i": "іⅰ", "j": "јϳ", "l": "ӏⅼ", "m": "ⅿ", "n": "ո",
    "o": "οоօⲟ", "p": "рρⲣ", "q": "ԛ", "s": "ѕ", "u": "ս", "v": "ѵνⅴ", "w": "ԝ", "x": "хⅹ", "y": "уү",
    "-": "‐‑",
}
# Ranges of characters that show nothing, and the kinds of space.
INVISIBLE = r"[\x{00}-\x{08}\x{0E}-\x{1F}\x{7F}-\x{84}\x{86}-\x{9F}\x{AD}\x{034F}\x{061C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{3164}\x{FE00}-\x{FE0F}\x{FEFF}\x{FFA0}\x{FFF9}-\x{FFFB}\x{E0000}-\x{E0FFF}]"
SPACES = "               　⠀"


def _compatible() -> dict[str, str]:
    """Width forms and other compatibility characters that show exactly their plain characters, by rule."""
    found = {}
    for cp in [*range(0xFF01, 0xFFEF), *range(0x2160, 0x2180), *range(0xFB00, 0xFB07)]:
        c = chr(cp)
        plain = unicodedata.normalize("NFKC", c)
        if plain != c and unicodedata.category(c) != "Cn" and not plain.isspace() and cp != 0xFFA0:
            found[c] = plain
    return found


def _composed(letters: dict[str, str]) -> dict[str, str]:
    """Accented look-alikes: the same accents on the Latin letter, in one character where there is one."""
    found = {}
    for cp in [*range(0x370, 0x530), *range(0x1F00, 0x2000)]:
        parts = unicodedata.normalize("NFD", chr(cp))
        if len(parts) > 1 and parts[0] in letters:
            found[chr(cp)] = unicodedata.normalize("NFC", letters[parts[0]] + parts[1:])
    return found


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _translate(inner: str, pairs: dict[str, str]) -> str:
    return f"translate({inner}, {_quoted(''.join(pairs))}, {_quoted(''.join(pairs.values()))})"


def form_sql(text: str = "text") -> str:
    """The DuckDB expression of a text's consistent form."""
    letters = {c: plain for plain, like in LOOK_ALIKES.items() for c in like}
    wide = _compatible()
    single = {c: p for c, p in wide.items() if len(p) == 1} | letters | dict.fromkeys(SPACES, " ") | {" ": "\n", " ": "\n"}
    sql = f"regexp_replace(regexp_replace({text}, '{INVISIBLE}+', '', 'g'), '\\r\\n?', chr(10), 'g')"
    spelled = sql
    for c, p in wide.items():
        if len(p) > 1:
            spelled = f"replace({spelled}, '{c}', '{p}')"
    several = "".join(c for c, p in wide.items() if len(p) > 1)
    sql = f"CASE WHEN regexp_matches({text}, '[{several}]') THEN {spelled} ELSE {sql} END"
    sql = f"nfc_normalize({_translate(sql, single)})"
    accented = _composed(letters)
    longer = {c: p for c, p in accented.items() if len(p) > 1}
    sql = _translate(sql, {c: p for c, p in accented.items() if len(p) == 1})
    # ASCII stays as it is, so a first look keeps the chain from most texts
    spelled = sql
    for c, p in longer.items():
        spelled = f"replace({spelled}, '{c}', '{p}')"
    return f"nfc_normalize(CASE WHEN regexp_matches({text}, '[\\x{{0300}}-\\x{{052F}}\\x{{1F00}}-\\x{{1FFF}}]') THEN {spelled} ELSE {sql} END)"


def _duck(df: DataFrame, columns: str, schema: str, where: str = "") -> DataFrame:
    """df (key, text) through a DuckDB statement over each Arrow batch."""
    names = df.columns
    statement = f"SELECT {columns} FROM (SELECT key, text, {form_sql()} AS form FROM batch) {where}"

    def run(batches):
        import duckdb

        con = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB"})
        for b in batches:
            for lo in range(0, b.num_rows, 2000):
                con.register("batch", pa.Table.from_batches([b.slice(lo, 2000)]).rename_columns(["key", "text"]))
                yield from con.sql(statement).to_arrow_table().to_batches()
                con.unregister("batch")

    assert len(names) == 2
    return df.mapInArrow(run, schema)


def consistent(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, form): the consistent form of each text."""
    kind = df.schema[key].dataType.simpleString()
    return _duck(df.select(key, text), f'key AS "{key}", form', f"`{key}` {kind}, form string")


_VISIBLE = "WHERE trim(form, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(133)) <> ''"


def look_alike_pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """(<key>_a, <key>_b), a < b: all pairs whose texts differ but show the same signs.

    Only digests travel. Forms with one spelling are left out first; spellings of a form are then
    paired, and only those pairs meet the documents, so exact copies are never compared with
    each other.
    """
    kind = df.schema[key].dataType.simpleString()
    digests = _duck(df.select(key, text), "key AS id, md5(form) AS form, md5(text) AS spelling", f"id {kind}, form string, spelling string", _VISIBLE)
    return pairs_of(written(digests, "digests"), key)  # read by several branches, and costly to make


#: Parts into which the documents of one spelling are spread where they meet other spellings.
SALTS = 8


def pairs_of(digests: DataFrame, key: str, salts: int = SALTS) -> DataFrame:
    """All pairs (<key>_a, <key>_b) of the rows (id, form, spelling) with equal forms and unequal spellings."""
    several = digests.groupBy("form").agg(F.min("spelling").alias("lo"), F.max("spelling").alias("hi")).where("lo <> hi").select("form")
    docs = digests.join(several, "form", "left_semi")
    spellings = docs.select("form", "spelling").distinct()
    links = spellings.alias("a").join(spellings.alias("b"), F.expr("a.form = b.form AND a.spelling < b.spelling")).select(F.col("a.spelling").alias("sa"), F.col("b.spelling").alias("sb"))
    part = F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    left = docs.select(F.col("spelling").alias("sa"), F.col("id").alias("ia"), part.alias("pa"))
    right = docs.select(F.col("spelling").alias("sb"), F.col("id").alias("ib"), part.alias("pb"))
    met = left.join(links.withColumn("pa", every), ["sa", "pa"]).withColumn("pb", every).join(right, ["sb", "pb"])
    return met.select(F.least("ia", "ib").alias(f"{key}_a"), F.greatest("ia", "ib").alias(f"{key}_b"))


def classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(<key>, <key>_of_form, <key>_of_text): the least key that shows the same signs, and the least with the same text.

    One row per row with visible signs, so copies are named once and never paired; rows are of one
    look but unequal texts if only the last column differs.
    """
    kind = df.schema[key].dataType.simpleString()
    digests = written(_duck(df.select(key, text), "key AS id, md5(form) AS form, md5(text) AS spelling", f"id {kind}, form string, spelling string", _VISIBLE), "digests")
    of_text = digests.groupBy("form", "spelling").agg(F.min("id").alias("of_text"))
    of_form = of_text.groupBy("form").agg(F.min("of_text").alias("of_form"))
    named = digests.join(of_text, ["form", "spelling"]).join(of_form, "form")
    return named.select(F.col("id").alias(key), F.col("of_form").alias(f"{key}_of_form"), F.col("of_text").alias(f"{key}_of_text"))
