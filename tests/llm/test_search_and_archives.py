"""Whitening, ranked search and archives against brute force, exact round trips and SQL, on small tables."""

import base64
import gzip
import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lakemart.llm import lexical_search, queries, warc, whitening
from lakemart.session import scratch_path

SF_DIR = "/root/testdata/sf0.001"


# ---- whitening -----------------------------------------------------------------


def whitened_by_hand(vectors, most=16):
    """What ``whiten`` returns for (id, vector) rows of one length, from numpy's covariance."""
    x = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in vectors]
    fit = np.array(sorted({tuple(v) for _, v in x}))
    n, sums, mean = len(fit), fit.sum(0), fit.sum(0) / len(fit)
    values, axes = np.linalg.eigh((fit - mean).T @ (fit - mean) / n)
    values, axes = values[::-1][:most], axes[:, ::-1][:, :most]
    rows = []
    for i, v in x:
        white = (np.array(v) - mean) @ axes / np.sqrt(values)
        rows.append((i, n, sum((n * int(c) - int(s)) ** 2 for c, s in zip(v, sums)), white))
    return rows, values / (((fit - mean) ** 2).sum() / n)


def check_whitened(got, vectors, dims):
    rows, shares = whitened_by_hand(vectors)
    by_id = {}
    for r in got:
        by_id.setdefault(r["vec_id"], []).append(r)
    assert sorted(by_id, key=str) == sorted((i for i, *_ in rows), key=str)
    # Signs are free, but the same for all rows.
    signs = np.ones(min(16, dims))
    for i, n, deviation, white in rows:
        mine = sorted(by_id[i], key=lambda r: r["component"])[: min(16, dims)] if len(by_id[i]) > min(16, dims) else sorted(by_id[i], key=lambda r: r["component"])
        assert {r["n"] for r in mine} == {n} and {r["deviation"] for r in mine} == {deviation}
        for j, r in enumerate(mine):
            if abs(white[j]) > 0.5 and i == rows[0][0]:
                signs[j] = np.sign(white[j] * r["whitened"])
    for i, _, _, white in rows:
        for r in by_id[i]:
            j = r["component"] - 1
            assert abs(abs(r["whitened"]) - abs(white[j])) < 1e-9
            assert abs(r["explained"] - shares[j]) < 1e-9 and r["identity_error"] < 1e-9


def test_whitening_matches_numpy(spark):
    given = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF_DIR}/embeddings.parquet'").fetchall()
    got = queries.op11_whitening(spark, SF_DIR).collect()
    assert len(got) == 16 * len(given)
    check_whitened(got, given, 64)
    white = np.zeros((len(given), 16))
    at = {i: p for p, (i, _) in enumerate(given)}
    for r in got:
        white[at[r["vec_id"]], r["component"] - 1] = r["whitened"]
    fit = white[[at[i] for i in {tuple(v): i for i, v in given}.values()]]
    cov = (fit - fit.mean(0)).T @ (fit - fit.mean(0)) / len(fit)
    assert np.abs(cov - np.eye(16)).max() < 1e-6


def test_whitening_of_odd_rows(spark):
    r = random.Random(5)
    good = [(i, [r.uniform(-3, 3) for _ in range(5)]) for i in range(40)]
    rows = [(i, v, "a") for i, v in good] + [(i, v, "b") for i, v in good[:7]] + [(100 + i, good[3][1], "copy") for i in range(30)]
    bad = [(None, "n"), ([], "e"), ([1.0, None, 1.0, 1.0, 1.0], "h"), ([1.0, math.nan, 1.0, 1.0, 1.0], "x"), ([math.inf] * 5, "i"), ([1e300] * 5, "u"), ([1.0, 2.0], "s")]
    named = [(200 + i, v, t) for i, (v, t) in enumerate(bad)] + [(None, [0.5] * 5, None)]
    df = spark.createDataFrame(rows + named, "vec_id long, embedding array<double>, component string")
    got = whitening.whiten(df).collect()
    kept = [(i, v) for i, v, _ in rows] + [(None, [0.5] * 5)]
    assert Counter(r["vec_id"] for r in got) == Counter({i: 5 * c for i, c in Counter(i for i, _ in kept).items()})
    assert {r["component"] for r in got} == {1, 2, 3, 4, 5} and {r["n"] for r in got} == {41}
    check_whitened(got, list({i: (i, v) for i, v in kept}.values()), 5)


def test_products_are_exact_for_wide_numbers(spark):
    r = random.Random(9)
    rows = [[r.randrange(-(1 << 45), 1 << 45), r.randrange(3), 7] for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in rows], "x array<bigint>").repartition(3)
    fit = whitening.fit_products(df, 3)
    n, sums = len(rows), [sum(v[i] for v in rows) for i in range(3)]
    assert fit.n == n and [s + n * lo for s, lo in zip(fit.sums, fit.low)] == sums
    assert fit.centred == [[n * sum(v[i] * v[j] for v in rows) - sums[i] * sums[j] for j in range(3)] for i in range(3)]
    project = whitening._projector(fit, *fit.components(3)[:2])
    off, _ = project(np.array(rows))
    assert off.tolist() == [[n * c - s for c, s in zip(v, sums)] for v in rows]


def test_deviations_beyond_a_long(spark):
    df = spark.createDataFrame([(i, [float(i % 2) * 2.0**40, float(i)]) for i in range(50)], "vec_id long, embedding array<double>")
    got = whitening.whiten(df).where("component = 1").collect()
    assert len(got) == 50 and all(r["deviation"] is None and r["deviation_exact"] > 1 << 63 for r in got)


def test_whitening_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(i, [1.0, 2.0]) for i in range(5)]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).count() == 0
    got = whitening.whiten(spark.createDataFrame([(i, [1.0, float(i)]) for i in range(5)], schema)).collect()
    assert {r["component"] for r in got} == {1} and len(got) == 5 and got[0]["explained"] == 1.0


# ---- ranked search -------------------------------------------------------------


def ranked_by_hand(docs, items, k=10):
    """``(item, rank, doc, score)`` of (id, text) rows, straight from the definition."""

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))

    bags = [(i, Counter(words(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n_docs, total, df = len(bags), sum(n for *_, n in bags), Counter(t for _, b, _ in bags for t in b)
    named = {}
    for i, t in {(i, t) for i, t in items}:
        named.setdefault(i, Counter()).update(words(t))
    out = []
    for item, bag in named.items():
        scores = []
        for i, b, n in bags:
            m = 100 - 75 + (75 * n * n_docs) // total
            score = sum(
                q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * b[t] // (1000 * b[t] + 8 * m))
                for t, q in bag.items()
                if t in b
            )
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


@pytest.mark.parametrize("segment,first_read", [(4096, 32), (16, 1), (50, 3)])
def test_search_matches_brute_force(spark, monkeypatch, segment, first_read):
    monkeypatch.setattr(lexical_search, "SEGMENT_ROWS", segment)
    monkeypatch.setattr(lexical_search, "FIRST_READ", first_read)
    monkeypatch.setattr(lexical_search, "ITEM_BLOCK", 7)
    monkeypatch.setattr(lexical_search, "FIRST_WAVE", 3)
    r = random.Random(segment)
    words = [f"w{int(r.paretovariate(0.7))}" for _ in range(400)] + ["Ärger", "ÄRGER", "x1", "X1"]
    docs = [(i, r.choice([" ", "-", "\n"]).join(r.choice(words) for _ in range(r.choice([1, 3, 20, 60])))) for i in range(300)]
    docs += [(1000 + i, docs[7][1]) for i in range(60)] + [(2000, None), (2001, ""), (2002, "?! --"), (5, docs[5][1]), (None, docs[9][1]), (3000, "w1 " * 30_000)]
    items = [(i, " ".join(r.choice(words) for _ in range(r.choice([1, 2, 8, 30])))) for i in range(20)]
    items += [(50, None), (51, ""), (52, "absent"), (3, "w2 w3 w3"), (0, items[0][1]), (None, "w1 w5")]
    given = spark.createDataFrame([(*d, "z", 1) for d in docs], "doc_id long, text string, score string, item_id int").repartition(4)
    asked = spark.createDataFrame([(*i, 0) for i in items], "item_id long, text string, rank int")
    got = lexical_search.rank_documents(given, asked)
    assert sorted((tuple(x) for x in got.select("item_id", "rank", "doc_id", "score").collect()), key=str) == ranked_by_hand(docs, items)


def test_nra_reads_no_more_than_it_must():
    """A segment that cannot reach the bound is left after one read; ties at the bound are kept."""
    docs, imp = np.arange(1000), np.arange(1000, 0, -1)
    reads = []

    class Counted:
        def __init__(self, x):
            self.x = x

        def __len__(self):
            return len(self.x)

        def __getitem__(self, at):
            if isinstance(at, slice):
                reads.append(at.stop)
            return self.x[at]

    found, scores = lexical_search.nra([(Counted(docs), imp), (docs[::-1], imp)], 1000, 10, 2_500)
    assert len(found) == 0 and reads == [lexical_search.FIRST_READ]
    found, scores = lexical_search.nra([(docs, imp), (docs[::-1], imp)], 1000, 10, 1_001)
    assert len(found) == 1000 and set(scores.tolist()) == {1001}


def test_search_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical_search.rank_documents(docs, items).count() == 0
    assert lexical_search.rank_documents(items.toDF("doc_id", "text"), docs.toDF("item_id", "text")).count() == 0


# ---- archives ------------------------------------------------------------------


def written(spark, pages, **options):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages, path, **options)
    return path


def files(path):
    import glob

    return [open(f, "rb").read() for f in sorted(glob.glob(f"{path}/part-*"))]


def test_archives_are_plain_gzip_members(spark):
    path = written(spark, spark.read.parquet(f"{SF_DIR}/pages.parquet").repartition(3))
    text = b"".join(gzip.decompress(f) for f in files(path)).decode()
    heads = re.findall(r"WARC/1\.1\r\nWARC-Type: (\w+)\r\n", text)
    assert Counter(heads)["warcinfo"] == len(files(path)) and len(heads) - len(files(path)) == 50
    assert all(f.endswith(warc.EMPTY_MEMBER) for f in files(path))


PAGES = [
    (5, "http://a/\r\nX: y z", "<p>one</p>", "q"), (2, None, "<p>one</p>", "q"), (9, "u", "<p>one</p>", None), (3, "u", None, "q"), (4, "u", "", "q"),
    (7, "ü", "日本語 🙂 \r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n", "q"), (None, "u", "<p>one</p>", "q"), (None, "u", "alone", "q"),
    (8, "u", "x y " * 200_000, "q"), (8, "u", "x y " * 200_000, "q"), (11, "u", "\x00\x1f", "q"),
]


def described(rows, least=0):
    """(page, bytes, digest, type, refers) of each row from the definition."""
    firsts = {}
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        if i is not None and len(body) >= least:
            firsts[body] = min(firsts.get(body, i), i)
    out = []
    for i, _, html, *_ in rows:
        body = (html or "").encode()
        first = firsts.get(body)
        revisit = first is not None and i != first
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((i, len(body), digest, "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


def shown(records):
    pages = records.where("record_type <> 'warcinfo'")
    rows = pages.select(F.col("key").cast("long"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long")).collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("least", [0, 11])
@pytest.mark.parametrize("payload", [True, False])
def test_archives_of_odd_pages(spark, least, payload):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string, key string").repartition(3)
    records = warc.read_archives(spark, written(spark, pages, least_bytes=least), with_payload=payload)
    assert shown(records) == described(PAGES, least)
    if payload:
        back = warc.restore_payloads(records).where("record_type <> 'warcinfo'").select(F.col("key").cast("long"), F.col("payload")).collect()
        assert sorted(((k, bytes(p)) for k, p in back), key=str) == sorted(((i, (h or "").encode()) for i, _, h, _ in PAGES), key=str)
        uris = {r["key"]: r["uri"] for r in records.collect()}
        assert uris["5"] == "http://a/%0D%0AX:%20y%20z" and uris["2"] is None and uris["7"] == "ü"


def test_archives_of_an_empty_table(spark):
    path = written(spark, spark.createDataFrame([], "page_id long, url string, html string"))
    assert warc.read_archives(spark, path).where("record_type <> 'warcinfo'").count() == 0


@pytest.mark.parametrize("size", ["211b", "2k", "64m"])
def test_ranges_that_cut_members_with_magic_inside(spark, size):
    """Stored members full of gzip magic, headers and whole foreign members, over ranges of every kind of length."""
    r = random.Random(3)
    bait = [warc.MAGIC, warc.MAGIC + b"\x04\0\0\0\0\0\x03\xff\xff", warc.EMPTY_MEMBER, gzip.compress(b"other", mtime=0), b"text "]
    rows = [(i, "u", b"".join(r.choice(bait) for _ in range(r.choice([0, 1, 5, 60, 250])))) for i in range(14)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html binary").repartition(2)
    path = written(spark, pages, level=0)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1b")
        records = warc.restore_payloads(warc.read_archives(spark, path)).where("record_type <> 'warcinfo'").collect()
    finally:
        for k, v in kept.items():
            spark.conf.set(k, v)
    assert sorted((int(x["key"]), bytes(x["payload"])) for x in records) == sorted((i, h) for i, _, h in rows)


@pytest.mark.parametrize("name", ["a.warc.gz", "a.warc"])
def test_bytes_between_members_are_passed_over(spark, folder, name):
    path = written(spark, spark.createDataFrame(PAGES[:4], "page_id long, url string, html string, key string").coalesce(1))
    (whole,) = files(path)
    parts = whole.split(warc.MAGIC)
    cut = warc.MAGIC + parts[3][: len(parts[3]) // 2]
    noise = b"noise" + warc.MAGIC.join(parts[:2]) + b"\n\n" + cut + warc.MAGIC + warc.MAGIC.join(parts[2:]) + cut
    with open(f"{folder}/{name}", "wb") as f:
        f.write(noise)
    assert shown(warc.read_archives(spark, folder)) == described(PAGES[:4])
