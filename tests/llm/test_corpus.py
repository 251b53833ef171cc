"""The corpus operators against brute force, exact round trips and held-out labels, on small tables."""

import hashlib
import random
import re
from collections import Counter
from itertools import combinations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from lakemart.llm import (
    chat_format,
    decontaminate,
    html_text,
    license_scan,
    line_dedup,
    ngram_join,
    queries,
    sentencepiece_codec,
    shingles,
    token_count,
    topk,
    toxicity,
)
from lakemart.llm.common import components
from lakemart.llm.pieces import SPACE

SF_DIR = "/root/testdata/sf0.001"
MODEL = queries.piece_model()
STRANGE = ["", None, " ", "a  b", "  x ", "\n\n\t", "日本語 🙂🙂 x", "é é", "▁x", "x" * 3000, "\x00a", "A b C d", "a b c d e f"]


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture
def odd(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns named like those that operators add."""
    rows = [(i, t, 1, "x") for i, t in enumerate(STRANGE)] + [(3, "a  b", 1, "x"), (None, "a b c d e f", 2, "y"), (90, "q " * 20000, 2, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, `a.b` string")


def ascii_words(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def shingle_set(text):
    w = ascii_words(text)
    if len(w) < 5:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def similar_components(rows, percent=75):
    found = {i: i for i, _ in rows}

    def top(i):
        while found[i] != i:
            i = found[i]
        return i

    sets = [(i, shingle_set(t)) for i, t in rows]
    for (i, a), (j, b) in combinations(sets, 2):
        if a and b and 100 * len(a & b) >= percent * len(a | b):
            x, y = sorted((top(i), top(j)))
            found[y] = x
    return {i: top(i) for i in found}


def near_copies(seed, n=120):
    """Texts of 1 to 60 words in families, with copies that differ by up to a few words."""
    r = random.Random(seed)
    texts, words = [], [f"w{i}" for i in range(300)]
    while len(texts) < n:
        base = [r.choice(words) for _ in range(r.choice([1, 3, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60]))]
        for _ in range(r.randint(1, 6)):
            copy = list(base)
            for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                copy[r.randrange(len(copy))] = r.choice(words)
            if r.random() < 0.3:
                copy.append(r.choice(words))
            texts.append(r.choice([" ", "\n", "\t "]).join(copy).upper() if r.random() < 0.2 else " ".join(copy))
    return list(enumerate(texts))


# -- 1 line dedup --------------------------------------------------------------------------------


def repeated_brute(rows, percent):
    sets, gone = [], set()
    for key, text in sorted((k, t) for k, t in rows if k is not None and t is not None):
        for at, line in enumerate(text.split("\n")):
            words = frozenset(re.split("[ \t\r\x0b\x0c]+", line.lower())) - {""}
            if words and any(100 * len(words & s) >= percent * len(words | s) for s in sets):
                gone.add((key, at))
            if words:
                sets.append(words)
    return gone


@pytest.mark.parametrize("percent", [85, 75])
def test_line_dedup_matches_brute_force(spark, percent):
    r = random.Random(3)
    words = [f"v{i}" for i in range(40)]
    lines = [" ".join(r.choice(words) for _ in range(r.randint(1, 25))) for _ in range(60)]
    rows = []
    for i in range(40):
        text = []
        for _ in range(r.randint(1, 8)):
            line = r.choice(lines).split(" ")
            if r.random() < 0.4:
                line[r.randrange(len(line))] = r.choice(words)
            text.append(r.choice([" ", "\t", "  "]).join(line))
        rows.append((i, "\n".join(text)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(x._key, x._pos) for x in line_dedup.repeated_lines(docs, "doc_id", "text", percent).collect()}
    assert got == repeated_brute(rows, percent)


@pytest.mark.parametrize("percent", [85, 75, 60])
def test_similar_lines_share_signatures(spark, percent):
    """In the class of the larger set, as many as the class says; at 85 sets of other words share next to none."""
    r = random.Random(5)
    pairs = []
    for _ in range(300):
        n = r.choice([*range(1, 30), 57, 58, 59, 88, 90, 150])
        a = [f"w{r.randrange(10**6)}" for _ in range(n)]
        b = a[: n - r.randint(0, n // 3)] + [f"w{r.randrange(10**6)}" for _ in range(r.randint(0, 1 + n // 8))]
        pairs.append((" ".join(a), " ".join(b)))
    lines = spark.createDataFrame([(i, side, line) for i, p in enumerate(pairs) for side, line in enumerate(p)], "i int, side int, line string")
    keyed = lines.select("i", "side", line_dedup.line_keys(F.col("line")).alias("_keys")).withColumn("n", F.size("_keys"))
    rows = {(x.i, x.side): x for x in line_dedup.with_signatures(keyed, percent).collect()}
    met = 0
    for i, (a, b) in enumerate(pairs):
        a, b = set(a.split()), set(b.split())
        if a != b and 100 * len(a & b) >= percent * len(a | b):
            met += 1
            shares = [s for least, _, s in line_dedup.size_classes(percent) if least <= max(len(a), len(b))][-1]
            assert len(set(rows[i, 0].signatures) & set(rows[i, 1].signatures)) >= shares
    assert met > 30
    apart = [set(rows[i, 0].signatures) for i in range(len(pairs)) if rows[i, 0].n >= 26]
    assert percent < 85 or sum(map(len, apart)) - len(set().union(*apart)) < 0.05 * sum(map(len, apart))


def test_line_dedup_verifies_next_to_similar_lines_only(spark, monkeypatch):
    """Lines that meet by chance, for they are of few common words, are told apart by their sketches before their words are compared."""
    r = random.Random(7)
    words = [f"v{i}" for i in range(60)]
    lines = [r.sample(words, r.randint(17, 30)) for _ in range(3000)]
    lines += [line[1:] for line in lines[:25]]
    docs = spark.createDataFrame([(i, "\n".join(map(" ".join, lines[i : i + 10]))) for i in range(0, len(lines), 10)], "doc_id long, text string")
    verified, write = [], line_dedup.materialize

    def counted(df, label):
        made = write(df, label)
        if label == "line-pairs":
            verified.append(made.count())
        return made

    monkeypatch.setattr(line_dedup, "materialize", counted)
    gone = line_dedup.repeated_lines(docs, "doc_id", "text").collect()
    assert len(gone) >= 25 and sum(verified) < 2 * len(gone)


def test_line_dedup_odd_rows(spark, odd):
    rows = line_dedup.dedup_lines(odd.withColumn("n_lines", F.lit("old"))).collect()
    assert len(rows) == odd.count()
    by = {(x.doc_id, x.text) for x in rows}
    assert (None, "a b c d e f") in by and (1, None) in by and (0, "") in by
    assert {x["a.b"] for x in rows} == {"x", "y", None}
    assert line_dedup.dedup_lines(odd.limit(0)).collect() == []


def test_line_dedup_texts_of_one_key(spark):
    """Lines belong to a text, not to its key; repeated rows are one document."""
    lines = ["a b c d e f g", "h i j k l m n", "o p q r s t u"]
    rows = [(1, "\n".join(lines[:2])), (1, lines[2]), (1, lines[2]), (0, lines[0]), (None, lines[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_tie", F.lit("own")).withColumn("_c0", F.lit("own"))
    got = sorted(((x.doc_id, x.text, x._tie, x._c0) for x in line_dedup.dedup_lines(docs).collect()), key=str)
    want = [(1, lines[1]), (1, lines[2]), (1, lines[2]), (0, lines[0]), (None, lines[0])]
    assert got == sorted(((*x, "own", "own") for x in want), key=str)
    # Equal texts of different keys, and one line in two texts of a key: the one with the lesser hash keeps it.
    both = spark.createDataFrame([(1, lines[0] + "\n" + lines[1]), (1, lines[0] + "\n" + lines[2])], "doc_id long, text string")
    left = sorted(x.text for x in line_dedup.dedup_lines(both).collect())
    assert left in ([lines[0] + "\n" + lines[1], lines[2]], [lines[0] + "\n" + lines[2], lines[1]])


def test_native_operators_run_no_python(spark):
    docs = spark.createDataFrame([(1, "a b\nc d"), (2, "a b")], "doc_id long, text string")
    plans = [line_dedup.dedup_lines(docs), queries.op7_chat_format(spark, SF_DIR)]
    for df in plans:
        assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


# -- 2 licence scan ------------------------------------------------------------------------------


def test_license_scan(spark):
    rows = [
        (1, "Intro line.\nReleased under the MIT License.\nMore text of no kind."),
        (2, "This work is licensed under the GNU General Public License, version 3."),
        (3, "Licensed under the Apache License, Version 2.0, see below."),
        (4, "Licensed under CC BY-NC 4.0."),
        (5, "A driving license is needed.\nThe public reads the code of the city."),
        (6, ""),
        (7, None),
        (None, "Released under the MIT License."),
    ] + [(10 + i, f"Plain words number {i} and nothing else.") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("family", F.lit("clash"))
    found = {(x.doc_id, x.line_no, x.family) for x in license_scan.scan(docs).collect() if x.confirmed}
    assert found == {(1, 1, "mit"), (2, 0, "gpl"), (3, 0, "apache"), (4, 0, "cc"), (None, 0, "mit")}
    assert license_scan.scan(docs.limit(0)).collect() == []


# -- 3 shingle join ------------------------------------------------------------------------------


@pytest.mark.parametrize("seed", [1, 2])
def test_ngram_join_matches_brute_force(spark, seed):
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in ngram_join.similar_documents(docs).collect()}
    want = similar_components(rows)
    assert got == {i: (len(shingle_set(t)), want[i]) for i, t in rows}


def test_ngram_join_passages_of_many_documents(spark):
    """Pairs of 13 to 21 shingles, most of them shared by hundreds of documents, on both sides of the light bound."""
    r, rows = random.Random(5), []

    def fresh(n):
        return [f"w{r.randrange(10**9)}" for _ in range(n)]

    for _ in range(3):
        passage = fresh(14)
        texts = [passage + fresh(60) for _ in range(150)]
        for _ in range(40):
            n, m = r.randint(13, 16), r.randint(17, 21)
            own = max(ngram_join.need(n, m), 10) - 10
            if 10 + own <= n:
                common = fresh(own)
                texts += [passage + common + fresh(n - 10 - own), passage + common + fresh(m - 10 - own)]
        rows += [" ".join(x) for x in texts]
    r.shuffle(rows)
    rows = list(enumerate(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert (ngram_join.rarity(docs.select("doc_id", "text").withColumnRenamed("text", "_text"), 5) > 0).any()
    got = {x.doc_id: x.component_id for x in ngram_join.similar_documents(docs).collect()}
    assert got == similar_components(rows)


def test_ngram_join_odd_rows(spark, odd):
    rows = ngram_join.similar_documents(odd).collect()
    assert len(rows) == odd.count()
    by = {x.doc_id: x for x in rows}
    assert by[0].component_id == 0 and by[0].n_shingles == 0 and by[1].n_shingles == 0
    assert by[None].component_id is None
    kept = ngram_join.keep_one(odd)
    assert kept.columns == odd.columns and sum(x.doc_id == 3 for x in kept.collect()) == 1
    assert ngram_join.similar_documents(odd.limit(0)).collect() == []


@pytest.mark.parametrize("length", [7, 60])
def test_ngram_join_texts_of_one_key(spark, length):
    """Each text of a key has its own links; repeated rows count once."""
    a, b, c = ([f"{x}{i}" for i in range(length)] for x in "abc")
    near = lambda words: " ".join(words + ["more"])
    rows = [(1, a), (1, b), (1, b), (0, c), (4, c)]
    rows = [(i, " ".join(t)) for i, t in rows] + [(2, near(a)), (3, near(b)), (1, ""), (None, " ".join(a))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_key", F.lit("own"))
    got = Counter((x.doc_id, x.component_id) for x in ngram_join.similar_documents(docs).collect())
    assert got == {(1, 1): 4, (0, 0): 1, (4, 0): 1, (2, 1): 1, (3, 1): 1, (None, None): 1}
    kept = sorted(((x.doc_id, x.text, x._key) for x in ngram_join.keep_one(docs).collect()), key=str)
    want = [(1, " ".join(a)), (1, " ".join(b)), (0, " ".join(c)), (1, ""), (None, " ".join(a))]
    assert kept == sorted(((*x, "own") for x in want), key=str)


def test_boundary_takes_the_cheaper_way():
    assert ngram_join.boundary({}, 75) == 0
    assert ngram_join.boundary({n: 100 for n in range(1, 17)}, 75) >= 4


def test_shingles_of_long_texts_do_not_depend_on_slices(monkeypatch):
    import pyarrow as pa

    texts = pa.array([" ".join(f"t{i % 97}" for i in range(5000)), None, "a b", "x" * 5000 + " y", ""])

    def all_sets():
        return [s.tolist() for _, made, counts in shingles.shingle_sets(texts) for s in np.split(made, np.cumsum(counts)[:-1])]

    whole = all_sets()
    monkeypatch.setattr(shingles, "SLICE_BYTES", 1000)
    assert all_sets() == whole


def test_shingles_take_little_memory_beside_the_texts():
    import tracemalloc

    import pyarrow as pa

    r = random.Random(3)
    texts = pa.array([" ".join(f"t{r.randrange(9999)}" for _ in range(400)) for _ in range(2000)])  # 4.5 MB
    shingles._powers.clear()
    tracemalloc.start()
    try:
        n = sum(len(made) for _, made, _ in shingles.shingle_sets(texts))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert n > 700_000 and peak < 50 << 20


def test_pipeline_hands_python_few_rows_at_a_time(spark, monkeypatch):
    import pyarrow as pa

    seen = []

    def stage(spark, docs, sf_dir):
        def sizes(batches):
            for b in batches:
                yield pa.RecordBatch.from_pydict({"doc_id": [b.num_rows]})

        seen.append(max(r[0] for r in docs.select("doc_id").coalesce(1).mapInArrow(sizes, "doc_id long").collect()))
        return docs

    many = lambda *_: spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"))
    monkeypatch.setattr(corpus_pipeline, "table", many)
    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", stage), ("last", lambda spark, docs, sf_dir: docs)])
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert corpus_pipeline.run(spark, SF_DIR).count() == 3000
    assert seen == [corpus_pipeline.BATCH_ROWS] and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_components(spark):
    links = spark.createDataFrame([(5, 9), (9, 7), (7, 3), (20, 21), (21, 20), (1, 2)], "a long, b long")
    assert {tuple(r) for r in components(links).collect()} == {(i, 3) for i in (3, 5, 7, 9)} | {(20, 20), (21, 20), (1, 1), (2, 1)}


# -- 4 and 9 pieces ------------------------------------------------------------------------------


def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.mark.parametrize("block", [sentencepiece_codec.BLOCK_CHARS, 1 << 16, 50])
def test_encoding_is_the_librarys(documents, block):
    sentencepiece_codec._known.clear()
    r = random.Random(1)
    texts = [t for _, t in documents] + [t for t in STRANGE if t is not None]
    texts += ["".join(r.choice("ab  é\n<s>▁thé 日🙂") for _ in range(r.randrange(60))) for _ in range(500)]
    got = sentencepiece_codec.encode_texts(texts, MODEL, block)
    assert [np.frombuffer(x, "<i4").tolist() for x in got] == library().encode(texts)
    assert [sentencepiece_codec.decode_ids(x, MODEL) for x in got] == [t.replace(SPACE, " ") for t in texts]


def test_matching_gives_all_chunks_in_one_array():
    """Strangers and long chunks among them; no array for each chunk."""
    words = ["the", "a🙂b", "x" * 300, "é", "", " " * 5 + "end", "龘龘", "\x00q"] * 20
    ids, cuts = sentencepiece_codec.matcher(MODEL).encode([SPACE + w.replace(" ", SPACE) for w in words])
    assert cuts.tolist()[0] == 0 and cuts[-1] == len(ids) and len(cuts) == len(words) + 1
    assert [chr(-1 - i) for i in ids[ids < 0]] == ["龘", "龘", "\x00"] * 20
    known = {}
    sentencepiece_codec._learn(words, MODEL, known)
    assert all(np.frombuffer(known[w], "<i4").tolist() == library().encode(w) for w in words if w)


def test_encode_and_decode_frames(spark, odd):
    made = sentencepiece_codec.encode(odd, MODEL)
    assert made.columns == [*odd.columns, "piece_ids"]
    back = sentencepiece_codec.decode(made.drop("text"), MODEL)
    key = lambda r: (str(r[0]), str(r[1]))
    want = [(r.doc_id, r.text if r.text is None else r.text.replace(SPACE, " ")) for r in odd.collect()]
    assert sorted([(r.doc_id, r.text) for r in back.collect()], key=key) == sorted(want, key=key)
    assert all(r.round_trip for r in sentencepiece_codec.digest(made, MODEL).collect())
    assert sentencepiece_codec.encode(odd.limit(0), MODEL).collect() == []


def test_token_counts_are_the_librarys(spark, odd):
    rows = odd.select("doc_id", "text").collect()
    want = Counter((r.doc_id, len((r.text or "").encode()), len(library().encode(r.text or ""))) for r in rows)
    got = token_count.count_tokens(odd, MODEL).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 4096) for r in got) and any(r.over_limit for r in got)
    assert token_count.count_tokens(odd.limit(0), MODEL).collect() == []


# -- 5 toxicity ----------------------------------------------------------------------------------


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def test_automaton_matches_edit_distance():
    r = random.Random(4)
    terms = {"".join(r.choice("abc") for _ in range(r.randint(3, 7))) for _ in range(20)}
    automaton = toxicity.Automaton({t: i for i, t in enumerate(sorted(terms))})
    for _ in range(2000):
        word = "".join(r.choice("abcd") for _ in range(r.randint(1, 8)))
        nearest = min(levenshtein(word, t) for t in terms)
        found = automaton.match(word)
        assert (found[1] if found else None) == (nearest if nearest <= 1 else None)


def toxic_corpus(spark, n=600):
    r = random.Random(6)
    plain = ["".join(r.choice(["ba", "to", "mi", "re", "lu"]) for _ in range(r.randint(1, 4))) for _ in range(200)]
    rows = []
    for i in range(n):
        words = [r.choice(plain) for _ in range(r.randint(20, 80))]
        toxic = i % 5 == 0
        for _ in range(r.randint(2, 4) if toxic else 0):
            words[r.randrange(len(words))] = r.choice(["scoundrel", "nitwit,", "buffoon."])
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"), {i: y for i, _, y in rows}


def test_toxicity_on_the_held_out_fold(spark):
    docs, labels, truth = toxic_corpus(spark)
    model = toxicity.train(docs, labels, toxicity.fold(F.col("doc_id")) != 1)
    scored = toxicity.with_scores(docs, model).withColumn("held", toxicity.fold(F.col("doc_id")) == 1).collect()
    assert all((r.score >= 0.7) == bool(truth[r.doc_id]) for r in scored if r.held)
    plain = "ba to mi relu tomi luba " * 4
    abuse, typo = model.score(plain + "you scoundrel and nitwit"), model.score(plain + "you scondrel and nitvit")
    said = model.score(plain + 'he wrote the words "scoundrel" and "nitwit" here')
    assert abuse >= 0.7 and said < abuse and model.score(plain) < typo < abuse
    kept = toxicity.keep_clean(docs.withColumn("score", F.lit("own")), model)
    assert kept.columns == ["doc_id", "text", "score"]
    assert {r.doc_id for r in kept.collect()} == {i for i, y in truth.items() if not y}


def test_misspellings_beside_clean_words_and_quotes(spark):
    """Clean documents with a neighbour of a term, or quoting the term, leave its other misspellings."""
    r = random.Random(8)
    plain = [f"w{i}x" for i in range(400)]
    rows = []
    for i in range(900):
        words = r.sample(plain, 20)
        if i % 3 == 0:
            words[3:3] = ["grobnak", "plimtosk"]
        elif i % 3 == 1:
            words[3:3] = ["robnak"]
        elif i % 30 == 2:
            words[3:3] = ["word", '"plimtosk"']
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    model = toxicity.train(docs, labels, F.lit(True))
    assert model.features("a brobnak b")[0] > 0 and model.features("a blimtosk b")[0] > 0
    assert model.features("a robnak b") == (0.0, 0.0)


def test_toxicity_without_labels(spark, odd):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(odd, none, F.lit(True))
    rows = toxicity.with_scores(odd, model).collect()
    assert len(rows) == odd.count() and {r.score for r in rows} == {model.score(None)} and model.score("") < 0.7
    assert toxicity.keep_clean(odd.limit(0), model).collect() == []


# -- 6 decontamination ---------------------------------------------------------------------------


def test_masks_leave_a_seed_in_every_sound_window():
    for n in (0, 1, 2):
        for changed in combinations(range(decontaminate.WINDOW), n):
            assert any(
                all(at + p not in changed for p in mask)
                for mask in decontaminate.MASKS
                for at in range(decontaminate.WINDOW - mask[-1])
            )


def test_short_masks_leave_a_seed():
    for n in range(1, decontaminate.WINDOW):
        for changed in range(n) if n >= decontaminate.FORGIVING else [n]:
            assert any(changed not in mask for mask, _ in decontaminate.masks_of(n))
    salts = [salt for n in range(1, decontaminate.WINDOW + 1) for _, salt in decontaminate.masks_of(n)]
    assert len(salts) == len(set(salts))


def leaks_brute(docs, items, least=5):
    found = set()
    for d, text in docs:
        doc = ascii_words(text)
        for i, test in items:
            item = ascii_words(test)
            width = min(13, len(item))
            need = 11 if width == 13 else width - 1 if width >= 5 else width
            if len(item) < least or d is None or text is None:
                continue
            for shift in range(-len(item) + width, len(doc) - width + 1):
                same = [0 <= shift + q < len(doc) and doc[shift + q] == item[q] for q in range(len(item))]
                low, high = max(0, -shift), min(len(item), len(doc) - shift)
                if any(sum(same[q : q + width]) >= need for q in range(low, high - width + 1)):
                    found.add((d, i))
    return found


def test_leaks_match_brute_force(spark):
    r = random.Random(8)
    words = [f"k{i}" for i in range(80)]
    items = [(i, " ".join(r.choice(words) for _ in range(n))) for i, n in enumerate([4, 6, 9, 12, 13, 14, 20, 30, 40, 55])]
    items += [(20, None), (21, ""), (6, items[6][1])]
    docs = []
    for d in range(80):
        body = [r.choice(words) for _ in range(r.randint(0, 60))]
        if d % 2:
            part = r.choice(items[:10])[1].split(" ")
            cut = r.randint(0, 3)
            part = part[cut : len(part) - r.randint(0, 5)]
            for _ in range(r.randint(0, 4)):
                if part:
                    part[r.randrange(len(part))] = "changed"
            at = r.randint(0, len(body))
            body[at:at] = part
        docs.append((d, r.choice([" ", "\n"]).join(body)))
    docs += [(200, None), (None, items[9][1]), (3, docs[3][1]), (201, f"so {items[0][1]} on"), (202, items[2][1].replace(" ", " x ", 1))]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(9))
    tests = spark.createDataFrame(items, "item_id long, text string")
    got = [(x.doc_id, x.item_id) for x in decontaminate.leaks(frame, tests).collect()]
    want = leaks_brute(docs, [(i, t or "") for i, t in items])
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 10
    every = [(x.doc_id, x.item_id) for x in decontaminate.leaks(frame, tests, least=2).collect()]
    assert len(every) == len(set(every)) and set(every) == leaks_brute(docs, [(i, t or "") for i, t in items], 2) > want
    kept = decontaminate.clean(frame, tests)
    assert kept.columns == frame.columns
    assert Counter(x.doc_id for x in kept.collect()) == Counter(d for d, _ in docs if d not in {d for d, _ in want})
    assert decontaminate.leaks(frame.limit(0), tests).collect() == [] and decontaminate.leaks(frame, tests.limit(0)).collect() == []


def test_short_items_forgive_one_word(spark):
    item = "who wrote the book of long winters in spain again"  # ten words
    docs = [
        (1, f"so {item} they asked"), (2, "so " + item.replace("book", "tale") + " they asked"),
        (3, item.replace("who", "he")), (4, item.replace("again", "once")), (5, item.replace("book", "tale").replace("in", "of")),
        (6, item.rpartition(" ")[0]), (7, "the cat sat down"), (8, "the cat sat up"), (9, "x " * 50_000 + item.replace("long", "short")),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    tests = spark.createDataFrame([(1, item), (2, "the cat sat down")], "item_id long, text string")
    found = {(x.doc_id, x.item_id, x.n_words, x.n_same) for x in decontaminate.leaks(frame, tests, least=4).collect()}
    assert found == {(1, 1, 10, 10), (2, 1, 10, 9), (3, 1, 10, 9), (4, 1, 10, 9), (9, 1, 10, 9), (7, 2, 4, 4)}
    assert not [x for x in decontaminate.leaks(frame, tests).collect() if x.item_id == 2]


# -- 7 chat --------------------------------------------------------------------------------------


def test_reply_trees(spark):
    nodes = [
        (1, 1, None, "user", "a", 0.0), (1, 2, 1, "assistant", "b ### x", 1.0), (1, 3, 1, "assistant", "c", 5.0),
        (1, 4, 2, "user", None, 1.0), (1, 5, 3, "user", "e\\h", 5.0), (1, 6, 3, "user", "</turn>\n", 0.0),
        (2, 1, 99, "us: er", "", None), (3, 1, 2, "user", "loop", 1.0), (3, 2, 1, "user", "loop", 1.0), (3, 5, 2, "user", "off it", 1.0),
        (None, 1, None, "user", "x", 1.0), (4, None, None, "user", "x", 1.0),
    ]
    frame = spark.createDataFrame(nodes, "conv_id long, node long, parent long, role string, text string, score double")
    made = chat_format.format_conversations(frame.withColumn("leaf", F.lit(7)), score="score").collect()
    assert [(r.conv_id, r.path_rank, r.leaf, r.n_turns) for r in sorted(made, key=lambda r: (r.conv_id, r.path_rank))] == [
        (1, 1, 5, 3), (1, 2, 6, 3), (1, 3, 4, 3), (2, 1, 1, 1),
    ]
    read = spark.createDataFrame(made).select(
        "conv_id", "path_rank", chat_format.read_turns(F.col("formatted")).alias("t"), chat_format.read_loss(F.col("formatted"), F.col("loss_spans")).alias("l")
    )
    by = {(r.conv_id, r.path_rank): r for r in read.collect()}
    assert [tuple(t) for t in by[1, 2].t] == [("user", "a"), ("assistant", "c"), ("user", "</turn>\n")]
    assert by[1, 3].l == "b ### x" and [tuple(t) for t in by[2, 1].t] == [("us: er", "")]
    best = chat_format.format_conversations(frame, score="score", top=1).collect()
    assert {(r.conv_id, r.leaf) for r in best} == {(1, 5), (2, 1)}
    assert chat_format.format_conversations(frame.limit(0)).collect() == []


def test_repeated_turns_and_nulls(spark):
    rows = [(1, 0, "user", "b"), (1, 0, "user", "b"), (1, 0, "user", "a"), (1, None, None, None), (1, 1, "assistant", "\\### Assistant: </turn> ok")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = chat_format.digest(chat_format.format_conversations(chat_format.linear_nodes(frame))).collect()
    turns = "".join(f"{a}\n{b}\n" for a, b in [("", ""), ("user", "a"), ("user", "b"), ("user", "b"), ("assistant", rows[4][3])])
    assert [(r.n_turns, r.turns_sha256, r.loss_chars) for r in got] == [(5, hashlib.sha256(turns.encode()).hexdigest(), len(rows[4][3]))]


# -- 8 top-k -------------------------------------------------------------------------------------


def top_brute(rows, k, every):
    sound = [(i, [int(np.floor(64 * x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = Counter()
    for a, (i, q) in enumerate(sound):
        if i % every == 0:
            scored = sorted((-sum(x * y for x, y in zip(q, v)), j) for b, (j, v) in enumerate(sound) if b != a and len(v) == len(q))
            out.update((i, rank + 1, j, -s) for rank, (s, j) in enumerate(scored[:k]))
    return out


@pytest.mark.parametrize("rows_per_segment", [65_536, 64])
def test_top_k_matches_brute_force(spark, monkeypatch, rows_per_segment):
    monkeypatch.setattr(topk, "SEGMENT_ROWS", rows_per_segment)
    monkeypatch.setattr(topk, "PART_ROWS", rows_per_segment * 7 // 8)
    r = random.Random(9)
    rows = [(i, [r.choice([-1.5, -0.5, 0.0, 0.25, r.uniform(-2, 2)]) for _ in range(6)]) for i in range(300)]
    rows += [(i, [0.5] * 6) for i in range(300, 330)] + [(40, [0.5] * 6), (500, None), (None, [1.0] * 6), (520, [float("nan")] * 6)]
    rows += [(540, [None, 1.0, 1.0, 1.0, 1.0, 1.0]), (560, [1.0, 2.0]), (561, [1.0, 3.0]), (580, []), (600, [float("inf")] * 6), (620, [100.0] * 6)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash"))
    rounded = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    got = Counter((x.query_id, x["rank"], x.vec_id, x.score) for x in topk.top_k(frame, k=7).collect())
    assert got == top_brute(rounded, 7, 20)
    assert topk.top_k(frame.limit(0)).collect() == []


def test_segments_follow_the_count_of_rows(spark):
    rows = spark.range(3_000).select(F.col("id").alias("vec_id"), F.array(F.col("id"), F.lit(7).cast("long")).alias("q"))
    for partitions in (1, 40):
        index = topk.build_index(rows.repartition(partitions)).collect()
        assert len(index) == 1 and index[0]["n"] == 3_000
        assert np.frombuffer(index[0]["ids"], np.int64).tolist() == list(range(3_000))


# -- 10 pages ------------------------------------------------------------------------------------


def test_blocks():
    page = "<html><head><title>t</title><style>x</style></head><body><!-- c --><p>a&amp;b <b>c</b>d<br>e<p> f\n g <script>var t='</p>'</script>h &copy<div class=ad>i</div"
    assert [b.text for b in html_text.blocks(page)] == ["a&b cd e", "f g", "h ©", "i"]
    assert html_text.blocks("") == [] and html_text.blocks("< >") and html_text.blocks("<p") == []


def test_labeller_on_held_out_pages():
    pages = html_text.composed_pages(150, seed=77)
    found = html_text.label_pages([p for p, _ in pages], html_text.fitted())
    right = sum(a == bool(b) for got, (_, want) in zip(found, pages) for a, b in zip(got, want))
    assert right >= 0.99 * sum(len(want) for _, want in pages)


def test_gradients_are_those_of_the_loss():
    model = html_text.Labeller(1)
    for name in model.w:
        model.w[name] = model.w[name].astype(np.float64)
    pages = [html_text._features(p) for p, _ in html_text.composed_pages(3, seed=2)]
    labels = np.array([y for _, ys in html_text.composed_pages(3, seed=2) for y in ys], float)
    grads, _ = model.gradients(pages, labels)
    for name in ("xf", "hf", "cb", "hb", "out", "bias"):
        at = np.unravel_index(np.abs(grads[name]).argmax(), grads[name].shape)
        ends = []
        for step in (1e-3, -1e-3):
            model.w[name][at] += step
            ends.append(model.gradients(pages, labels)[1])
            model.w[name][at] -= step
        assert abs((ends[0] - ends[1]) / 2e-3 - grads[name][at]) < 1e-3 + 0.02 * abs(grads[name][at])


def test_pages_table(spark):
    rows = spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()
    got = {r.page_id: r for r in queries.op10_html_text(spark, SF_DIR).collect()}
    from html import unescape

    for r in rows:
        inner = re.sub(r"<[^>]*\Z", "", re.search(r"<article>(.*?)(</article>|\Z)", r.html, re.S).group(1))
        parts = re.split(r"</?h1>|</?p>", inner)
        parts = [" ".join(unescape(re.sub(r"</?(?:b|i|em|a|strong)\b[^>]*>", "", p.replace("<br>", " "))).split()) for p in parts]
        want = "\n".join(p for p in parts if p)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want)


def test_pages_odd_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "u", ""), (2, "u", "<article><p>" + "word " * 60000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = html_text.extract(frame).collect()
    assert Counter((r.page_id, r.n_chars) for r in got) == Counter([(1, 0), (1, 0), (None, 0), (2, 299999)])


# -- queries and pipeline ------------------------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    db = duckdb.connect()
    for t in ("conversations", "embeddings", "documents", "benchmark", "pages"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    cursor = db.execute(queries.ORACLES[name])
    names = [d[0] for d in cursor.description]
    got = contract.queries()[name](spark, SF_DIR).select(*names)
    assert Counter(map(tuple, got.collect())) == Counter(cursor.fetchall())


def test_all_queries_are_registered():
    names = contract.queries()
    assert "pipeline" in names and [n for i in range(1, 14) for n in names if n.startswith(f"op{i}_")] == sorted(
        (n for n in names if re.match(r"op\d+_", n)), key=lambda n: int(n[2:].split("_")[0])
    )


def test_pipeline_matches_its_stages_by_brute_force(spark, documents):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = queries.toxicity_model(spark, docs, SF_DIR)
    rows = [(i, t) for i, t in documents if model.score(t) < 0.7]
    gone = repeated_brute(rows, line_dedup.PERCENT)
    left = []
    for i, t in rows:
        lines = t.split("\n")
        kept = [x for at, x in enumerate(lines) if (i, at) not in gone]
        if len(kept) == len(lines) or "".join(kept).strip():
            left.append((i, "\n".join(kept)))
    component = similar_components(left)
    left = [(i, t) for i, t in left if component[i] == i]
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF_DIR}/benchmark.parquet'").fetchall()
    dirty = {d for d, _ in leaks_brute(left, items)}
    want = {i: t for i, t in left if i not in dirty}
    made = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id: r.text for r in made} == want
    ids = library().encode([r.text for r in made])
    assert [np.frombuffer(r.piece_ids, "<i4").tolist() for r in made] == ids
    assert all(r.n_chars == len(r.text) for r in made)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
