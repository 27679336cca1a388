"""Queries of the text problems p7 to p9, and the DuckDB statements of those that SQL can express."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketloom.llm import encode, packing, visual
from marketloom.session import checkpoint_dir, table

Query = Callable[[SparkSession, str], DataFrame]


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode(table(spark, sf_dir, "documents"), "doc_id", "text")


def p7_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.round_trip(table(spark, sf_dir, "documents"), "doc_id", "text")


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    checkpoint_dir(spark)
    sizes = encode.token_counts(table(spark, sf_dir, "documents"), "doc_id", "text").checkpoint()
    return packing.pack(sizes, "doc_id", "n_tokens")


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visual.look_alike_pairs(table(spark, sf_dir, "documents"), "doc_id", "text")


def p9_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visual.consistent(table(spark, sf_dir, "documents"), "doc_id", "text")


def p9_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return visual.classes(table(spark, sf_dir, "documents"), "doc_id", "text")


def queries() -> dict[str, Query]:
    return {"p7_ids": p7_ids, "p7_round_trip": p7_round_trip, "p8_containers": p8_containers, "p9_found": p9_found, "p9_forms": p9_forms, "p9_classes": p9_classes}


def _shown() -> dict[str, str]:
    """What each character shows, by the Unicode database: made apart from the operator, sign by sign, to check it."""
    same = {c: plain for plain, like in visual.LOOK_ALIKES.items() for c in like}
    shown = {}
    for cp in (*range(0x80, 0x3400), *range(0xA000, 0xA500), *range(0xFB00, 0xFB07), *range(0xFE00, 0x10000), *range(0xE0000, 0xE1000)):
        c = chr(cp)
        kind = unicodedata.category(c)
        tag = unicodedata.decomposition(c).split(" ")[0]
        parts = unicodedata.normalize("NFD", c)
        if kind == "Zs" or cp == 0x2800:
            s = " "
        elif kind in ("Zl", "Zp"):
            s = "\n"
        elif unicodedata.name(c, "").startswith(("VARIATION SELECTOR", "MONGOLIAN FREE", "HANGUL FILLER", "HALFWIDTH HANGUL FILLER", "HANGUL CHOSEONG FILLER", "HANGUL JUNGSEONG FILLER", "COMBINING GRAPHEME JOINER", "KHMER VOWEL INHERENT")):
            s = ""
        elif (kind in ("Cf", "Cc") or 0xE0000 <= cp < 0xE1000 or 0x2060 <= cp < 0x2070) and cp != 0x85 and not 0x600 <= cp < 0x606 and cp not in (0x6DD, 0x70F, 0x8E2, 0x890, 0x891):
            s = ""
        elif tag in ("<wide>", "<narrow>") or 0xFB00 <= cp < 0xFB07 or 0x2160 <= cp < 0x2180:
            s = same.get(c) or unicodedata.normalize("NFKC", c)
        elif c in same or (parts[0] in same and len(parts) > 1):
            s = unicodedata.normalize("NFC", same[parts[0]] + parts[1:])
        else:
            continue
        shown[c] = s
    for cp in (*range(9), *range(0x0E, 0x20), 0x7F):
        shown[chr(cp)] = ""
    return shown | {"\r": "\n"}


_SIGNS = ", ".join(f"({ord(c)}, [{', '.join(str(ord(x)) for x in s)}]::INTEGER[])" for c, s in _shown().items() if c != "\0")
_FORMS = f"""
WITH signs(code, becomes) AS (VALUES {_SIGNS}),
tokens AS (SELECT doc_id, unnest(string_split(replace(text, chr(13) || chr(10), chr(10)), '')) AS c, generate_subscripts(string_split(replace(text, chr(13) || chr(10), chr(10)), ''), 1) AS i FROM documents WHERE text <> ''),
spelled AS (SELECT doc_id, i, CASE WHEN s.code IS NULL THEN c ELSE array_to_string([chr(x) for x in becomes], '') END AS c FROM tokens LEFT JOIN signs s ON ord(c) = s.code AND length(c) = 1),
forms AS (SELECT d.doc_id, d.text, CASE WHEN d.text = '' THEN '' WHEN d.text IS NOT NULL THEN nfc_normalize(coalesce(f.form, '')) END AS form
          FROM documents d LEFT JOIN (SELECT doc_id, string_agg(c, '' ORDER BY i) AS form FROM spelled GROUP BY doc_id) f ON f.doc_id = d.doc_id),
seen AS (SELECT * FROM forms WHERE trim(form, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(133)) <> '')
"""
P9_FORMS = _FORMS + "SELECT doc_id, form FROM forms"
P9_FOUND = _FORMS + "SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM seen a JOIN seen b ON a.form = b.form AND a.doc_id < b.doc_id AND a.text <> b.text"
P9_CLASSES = _FORMS + "SELECT doc_id, min(doc_id) OVER (PARTITION BY form) AS doc_id_of_form, min(doc_id) OVER (PARTITION BY form, text) AS doc_id_of_text FROM seen"


def oracle_sql() -> dict[str, str]:
    return {"p9_found": P9_FOUND, "p9_forms": P9_FORMS, "p9_classes": P9_CLASSES}
