"""Operator 11: fill-in-middle transformation of whole texts.

A text is cut into units (lines, by default) by repeated-capture matching: one ``fullmatch`` of
``(unit)*`` keeps every repetition, and ``match.ends(1)`` gives both the number of units and all
possible cut offsets. Two seeded hashes of the id pick the cuts; the parts are then reordered with
sentinels between them (psm: prefix, suffix, middle; spm: suffix, prefix, middle).

Each row is transformed by itself, so nothing is shuffled, a lost executor costs its own tasks only,
and reruns agree. A task holds one text and its cut offsets, and hands rows on in batches of at most
``BATCH_BYTES`` beyond the last row.

Defined cases: a null text counts as empty; an empty text and one that contains a sentinel stay as
they are (form plain); a null id is hashed as an empty one; repeated rows give equal results; bytes
that are not UTF-8 count as one character each and are kept; columns named like a result column are
replaced, all others are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ceasekit.llm.common import table

#: Units of the query's texts, and the sentinels before prefix, suffix and middle.
LINES = r"[^\n]*\n|[^\n]+"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

SEED = 7
FIM_PERCENT = 100       # of the texts that can be transformed
SPM_PERCENT = 50        # of the transformed ones
BATCH_BYTES = 16 << 20
ADDED = ["n", "form", "prefix_chars", "middle_chars"]


def cut(text: str, key: str, units: regex.Pattern, seed: int, fim_percent: int, spm_percent: int) -> tuple:
    """(units, form, prefix's characters, middle's characters, transformed text). A text that the units
    do not cover whole is plain and has no unit."""
    found = units.fullmatch(text)
    ends = found.ends(1) if found else []
    n = len(ends)
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i:i + 8], 16) for i in range(0, 32, 8))
    if n == 0 or h3 % 100 >= fim_percent or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    first, second = (ends[k - 1] if k else 0 for k in sorted((h1 % (n + 1), h2 % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if h4 % 100 < spm_percent:
        return n, "spm", first, second - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", first, second - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def transformer(unit: str, seed: int, fim_percent: int, spm_percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(f"({unit})*", regex.V0)
        names = ["_row", *ADDED, "_output"]
        types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        for b in batches:
            rows, start, held = [], 0, 0
            for i, (key, raw) in enumerate(zip(b.column("_key"), b.column("_text"), strict=True)):
                text = raw.as_py().decode("utf-8", "surrogateescape")
                *found, out = cut(text, key.as_py(), units, seed, fim_percent, spm_percent)
                rows.append((*found, out.encode("utf-8", "surrogateescape")))
                held += len(rows[-1][-1])
                if held >= BATCH_BYTES or i + 1 == len(b):
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
                    yield pa.RecordBatch.from_arrays([b.column("_row").slice(start, len(rows)), *columns], names=names)
                    rows, start, held = [], i + 1, 0
    return run


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text: str = "text", unit: str = LINES, seed: int = SEED,
                   fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """Every row of ``docs`` with its text transformed in place, and the number of units ``n``, the
    ``form`` (plain, psm, spm) and the characters of prefix and middle (null if plain)."""
    taken = {text.lower(), *ADDED}
    rest = [c for c in docs.columns if c.lower() not in taken]
    kept = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)]).alias("_row")   # not empty
    rows = docs.select(kept,
                       F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("_key"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary").alias("_text"))
    kind = rows.schema["_row"].dataType.simpleString()
    done = rows.mapInArrow(transformer(unit, seed, fim_percent, spm_percent),
                           f"_row {kind}, n bigint, form string, prefix_chars bigint, middle_chars bigint, _output binary")
    return done.select(*[F.col("_row").getField(f"c{i}").alias(c) for i, c in enumerate(rest)], F.col("_output").cast("string").alias(text), *ADDED)


def restored(output: Column, form: Column) -> Column:
    """The original text, rebuilt from a transformed one and its form. The first of each sentinel is the
    one that was put in, as texts that contain one are plain and no sentinel overlaps itself."""
    def after(value: Column, n_bytes: Column) -> Column:
        return F.substring(value.cast("binary"), n_bytes + 1, F.octet_length(value)).cast("string")

    def rebuild(first: str, second: str, third: str) -> Column:
        a_on = after(output, F.lit(len(first)))
        a = F.substring_index(a_on, second, 1)
        b_on = after(a_on, F.octet_length(a) + len(second))
        b = F.substring_index(b_on, third, 1)
        found = {first: a, second: b, third: after(b_on, F.octet_length(b) + len(third))}
        return F.concat(found[PREFIX], found[MIDDLE], found[SUFFIX])

    return F.when(form == "psm", rebuild(PREFIX, SUFFIX, MIDDLE)).when(form == "spm", rebuild(SUFFIX, PREFIX, MIDDLE)).otherwise(output)


def op11_fill_in_middle(spark, sf_dir: str) -> DataFrame:
    docs = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = [F.sha2(c.cast("binary"), 256).alias(k) for k, c in (
        ("output_sha256", F.col("text")), ("restored_sha256", restored(F.col("text"), F.col("form"))))]
    return docs.select("doc_id", *ADDED, *digest)


OP11_SQL = """
WITH units AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\n]*\\n|[^\\n]+') AS u, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), hashed AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
         ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
  FROM units
), parts AS (
  SELECT *, text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 AS plain,
         array_to_string(u[1:least(h1 % (n + 1), h2 % (n + 1))], '') AS p,
         array_to_string(u[least(h1 % (n + 1), h2 % (n + 1)) + 1:greatest(h1 % (n + 1), h2 % (n + 1))], '') AS m,
         array_to_string(u[greatest(h1 % (n + 1), h2 % (n + 1)) + 1:], '') AS s
  FROM hashed
)
SELECT doc_id, n::BIGINT AS n, CASE WHEN plain THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN length(p) END AS prefix_chars, CASE WHEN NOT plain THEN length(m) END AS middle_chars,
       sha256(CASE WHEN plain THEN text WHEN h4 % 100 < 50 THEN '<S>' || s || '<P>' || p || '<M>' || m
                   ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
