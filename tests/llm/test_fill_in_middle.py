"""Fill-in-middle against a line-by-line version in plain Python, and its defined cases."""

import hashlib
import random
import re

import pandas as pd
import pytest
import regex
from pyspark.sql import functions as F

from ceasekit.llm import fill_in_middle as fim

SF = "/root/testdata/sf0.001"


def plain(key, text, fim_percent=100, spm_percent=50):
    """One text by the contract, unit by unit."""
    units = [u + "\n" for u in text.split("\n")]
    units[-1] = units[-1][:-1]
    units = [u for u in units if u]
    n = len(units)
    h = hashlib.sha256(f"7:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= fim_percent:
        return n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm_percent:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def none(x):
    return None if pd.isna(x) else int(x)


def test_whole_table_against_plain(spark):
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    want = {i: plain(i, t or "") for i, t in zip(docs.doc_id, docs.text, strict=True)}
    got = fim.op11_fill_in_middle(spark, SF).toPandas()
    text = dict(zip(docs.doc_id, docs.text, strict=True))
    assert len(got) == len(docs) and set(got["form"]) >= {"psm", "spm"}
    for r in got.itertuples():
        n, form, p, m, out = want[r.doc_id]
        assert (r.n, r.form, none(r.prefix_chars), none(r.middle_chars)) == (n, form, p, m)
        assert r.output_sha256 == hashlib.sha256(out.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((text[r.doc_id] or "").encode()).hexdigest()


def test_cut_on_random_texts():
    units, rng = regex.compile(f"({fim.LINES})*", regex.V0), random.Random(3)
    for key in range(3000):
        text = "".join(rng.choices(["\n", "a", "é", "𝄞", "\r", "<P", ">", "<", "S>", "<M>"], k=rng.randint(0, 14)))
        assert fim.cut(text, str(key), units, 7, 60, 30) == plain(key, text, 60, 30)


def test_one_match_of_many_lines():
    units = regex.compile(f"({fim.LINES})*", regex.V0)
    n, form, *_ = fim.cut("line of text\n" * 1_000_000, "5", units, 7, 100, 50)
    assert n == 1_000_000 and form != "plain"


def test_defined_cases(spark, odd, empty):
    got = fim.fill_in_middle(odd.withColumn("N", F.lit("old")).withColumn("c0", F.lit(1)).withColumn("_row", F.lit(2))).toPandas()
    assert sorted(c for c in got if c.lower() == "n") == ["n"] and (got["c0"] == 1).all() and (got["_row"] == 2).all()
    assert len(got) == 9 and set(got.columns) >= {"doc_id", "text", "lang", "source", "n_chars"}
    blank = got[got["text"] == ""]
    assert len(blank) == 3 and (blank["form"] == "plain").all() and blank["prefix_chars"].isna().all() and (blank["n"] == 0).all()
    assert got[got.doc_id == 1].drop_duplicates().shape[0] == 1
    null_id = got[got.doc_id.isna() & (got["text"] != "")].iloc[0]
    assert (null_id["n"], null_id["form"], null_id["text"]) == tuple(plain("", "x " * 60)[i] for i in (0, 1, 4))
    assert fim.fill_in_middle(empty).count() == 0


@pytest.mark.parametrize("percent", [(0, 50), (100, 0), (100, 100)])
def test_rates_and_sentinels(spark, make, percent):
    rows = make([(i, f"a\nb{i}\nc" if i % 3 else f"a\n<M>{i}", "en", "s") for i in range(60)])
    got = fim.fill_in_middle(rows, fim_percent=percent[0], spm_percent=percent[1])
    got = got.withColumn("back", fim.restored(F.col("text"), F.col("form"))).toPandas().sort_values("doc_id")
    assert set(got["form"]) == ({"plain"} if percent[0] == 0 else {"plain", "spm" if percent[1] else "psm"})
    assert got["back"].tolist() == [f"a\nb{i}\nc" if i % 3 else f"a\n<M>{i}" for i in range(60)]


def test_bytes_that_are_not_utf8_survive(spark):
    rows = spark.sql("SELECT id AS doc_id, cast(unhex('FF0A61F0C30A0AE2') AS string) AS text FROM range(20)")
    got = fim.fill_in_middle(rows).withColumn("back", fim.restored(F.col("text"), F.col("form")).cast("binary"))
    assert {bytes(r["back"]) for r in got.select("back").collect()} == {bytes.fromhex("FF0A61F0C30A0AE2")}
    assert {r["n"] for r in got.collect()} == {4}
