"""Size-aware heavy-light join of documents by the Jaccard similarity of their word shingles.

Documents with equal sets are one class. Small sets (light) meet by hashing:
each writes a key for every subset of the size that a pair must share. Large
sets (heavy) scan inverted lists, namely those of their rarest shingles, of
which two similar sets share one. The boundary comes from the size histogram
and the cost of both ways. A list is cut into blocks of bounded size and a
pair of blocks is one unit of work, so no list has to fit in a task. Within
it, a bitmap per set bounds the difference of two sets from below, which rules
out nearly all pairs that are not similar. First every set is tried with its
nearest partner of another component, round by round, and found components are
joined; what is left between components is then verified pair by pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import components, map_batches, materialize, on_workers, settled, small, told_apart
from lakemart.llm.shingles import mix, shingle_sets

#: Sizes up to which the light way is weighed against the heavy one.
LIGHT_MOST = 16
#: Cost of scanning one inverted list, in subsets written.
LIST_COST = 6
#: Buckets of the count sketch that orders shingles by rarity: 4 MB at any input size; it never changes a result.
SKETCH = 1 << 20
#: Sets of a list that one unit of work takes from either side.
BLOCK = 8192
#: Rounds of nearest partners before the rest is verified in full.
ROUNDS = 2
#: Bits of a set's bitmap at least; larger sets have more, so that the bitmaps of unlike sets still differ enough.
_BITS = 1024


def need(n: int, m: int, percent: int = 75) -> int:
    """Shared shingles that sets of n and m must have: 100 * i >= percent * (n + m - i)."""
    return -(-percent * (n + m) // (100 + percent))


def rarity(docs: DataFrame, k: int) -> np.ndarray:
    """Level of each sketch bucket: 0 for ordinary shingles, else the power of two by which it is common."""
    parts = 64

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The counts of a whole task, however many batches it has."""
        total = np.zeros(SKETCH, np.int32)
        for batch in batches:
            for _, made, _ in shingle_sets(batch.column(0), k):
                np.add.at(total, (made % np.uint64(SKETCH)).astype(np.int64), 1)
        for i, x in enumerate(np.split(total, parts)):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([x.astype("<i4").tobytes()], pa.binary())], ["part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, "<i4").astype(np.int64) for x in table.column("counts").to_pylist())
        return pa.table({"part": table.column("part")[:1], "counts": pa.array([total.astype("<i8").tobytes()], pa.binary())})

    on_workers(docs.sparkSession)
    counted = docs.select("_text").mapInArrow(count, "part int, counts binary")
    rows = counted.groupBy("part").applyInArrow(add, "part int, counts binary").collect()
    total = np.zeros(SKETCH, np.int64)
    for r in rows:
        width = SKETCH // parts
        total[r["part"] * width : (r["part"] + 1) * width] = np.frombuffer(r["counts"], "<i8")
    over = total / max(4 * total.mean(), 8)
    return np.where(over > 1, np.log2(np.maximum(over, 1)).astype(np.int64) + 1, 0).astype(np.uint8)


_SETS = "_key bigint, _tie bigint, f1 bigint, f2 bigint, n int, tokens binary, bits binary"


def document_sets(docs: DataFrame, k: int, percent: int, levels: np.ndarray) -> DataFrame:
    """Per row: key and tie, fingerprint and size of its set, its rarest shingles (all, if small) by rarity, its bitmap."""

    def run(batch: pa.RecordBatch) -> pa.Table:
        out = {c: [] for c in ("f1", "f2", "n", "tokens", "bits")}
        for _, made, counts in shingle_sets(batch.column(2), k):
            ends = np.cumsum(counts)
            level = levels[(made % np.uint64(SKETCH)).astype(np.int64)]
            other = mix(made + np.uint64(0x632BE59BD9B4E019))
            for i, n in enumerate(counts.tolist()):
                part = slice(ends[i] - n, ends[i])
                # One order, by (level, hash), for sets of every size: prefixes only meet if all are taken in the same.
                order = np.argsort(level[part], kind="stable")
                h = made[part][order if n <= LIGHT_MOST else order[: n - -(-percent * n // 100) + 1]]
                width = _BITS
                while 4 * width < 3 * n:
                    width *= 2
                odd = np.bincount((made[part] % np.uint64(width)).astype(np.int64), minlength=width) & 1
                out["n"].append(n)
                out["f1"].append(np.int64(np.sum(made[part]).view(np.int64)) if n else 0)
                out["f2"].append(np.int64(np.sum(other[part]).view(np.int64)) if n else 0)
                out["tokens"].append(h.tobytes())
                out["bits"].append(np.packbits(odd.astype(np.uint8)).tobytes())
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
        return pa.table([batch.column(0), batch.column(1), *[pa.array(v, t) for v, t in zip(out.values(), kinds)]], ["_key", "_tie", *out])

    return map_batches(docs.select("_key", "_tie", "_text"), _SETS, run)


def boundary(sizes: dict[int, int], percent: int) -> int:
    """Largest size that takes the light way, where the total cost of both ways is least."""

    def light(n: int) -> int:
        low, high = -(-percent * n // 100), 100 * n // percent
        return sum(comb(n, need(n, m, percent)) for m in range(max(low, 1), high + 1) if need(n, m, percent) <= min(n, m))

    def heavy(n: int) -> int:
        return LIST_COST * (n - -(-percent * n // 100) + 1)

    best, cost = 0, 0.0
    total = 0.0
    for n in range(1, LIGHT_MOST + 1):
        total += sizes.get(n, 0) * (light(n) - heavy(n))
        if total < cost:
            best, cost = n, total
    return best


def signatures(sets: DataFrame, percent: int, edge: int) -> DataFrame:
    """``(sig, id)``: subset keys of sets up to ``edge``, rare shingles of those that a larger one may be similar to."""

    def run(batch: pa.RecordBatch) -> pa.Table:
        ids, sizes = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        sigs, owners = [], []
        for i, n, raw in zip(ids.tolist(), sizes.tolist(), batch.column(2).to_pylist()):
            h = np.frombuffer(raw, np.uint64)
            if n <= edge:
                keys = []
                for m in range(max(-(-percent * n // 100), 1), min(100 * n // percent, edge) + 1):
                    c = need(n, m, percent)
                    if c <= min(n, m):
                        pair = np.uint64((min(n, m) << 32) + max(n, m))
                        chosen = np.array(list(combinations(range(n), c)), np.int64).reshape(-1, c)
                        keys.append(mix(mix(h)[chosen].sum(axis=1, dtype=np.uint64) + pair))
                sigs.append(np.concatenate(keys) if keys else h[:0])
                owners.append(np.full(len(sigs[-1]), i, np.int64))
            if n * 100 >= percent * (edge + 1):
                h = h[: n - -(-percent * n // 100) + 1] if n <= LIGHT_MOST else h
                sigs.append(h)
                owners.append(np.full(len(h), i, np.int64))
        sig = np.concatenate(sigs).view(np.int64) if sigs else np.zeros(0, np.int64)
        return pa.table({"sig": sig, "id": np.concatenate(owners) if owners else np.zeros(0, np.int64)})

    return map_batches(sets.select("id", "n", "tokens"), "sig bigint, id bigint", run)


def _cells(lists: DataFrame, sets: DataFrame, labels: DataFrame | None, nearest: bool, percent: int) -> DataFrame:
    """Pairs of different components that the bitmaps allow, from the lists ``(sig, id)``.

    ``nearest``: for each set of a unit of work only the partner whose bitmap
    is nearest; else all.
    """
    posted = lists.withColumn("comp", F.col("id"))
    if labels is not None:
        known = labels.select("id", F.col("component").alias("_c"))
        posted = lists.join(small(known), "id", "left").select("sig", "id", F.coalesce("_c", "id").alias("comp"))
    spread = posted.groupBy("sig").agg(F.count("*").alias("_n"), F.min("comp").alias("_low"), F.max("comp").alias("_high"))
    spread = spread.where("_low <> _high").select("sig", F.ceil(F.col("_n") / BLOCK).cast("int").alias("_blocks"))
    rows = posted.join(spread, "sig")
    block = F.when(F.col("_blocks") == 1, 0).otherwise(F.pmod(F.xxhash64("id"), F.col("_blocks"))).cast("int")
    rows = rows.withColumn("_own", block).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    rows = rows.select(
        F.xxhash64("sig", F.least("_own", "_other"), F.greatest("_own", "_other")).alias("cell"),
        "id", "comp", (F.col("_own") <= F.col("_other")).alias("left"), (F.col("_own") >= F.col("_other")).alias("right"),
    )
    # The bitmaps come last, so that they go through one shuffle only.
    keyed = rows.join(sets.select("id", "n", "bits"), "id").select("cell", "id", "n", "comp", "bits", "left", "right")
    keyed = keyed.repartition("cell").sortWithinPartitions("cell")

    def sound(a: np.ndarray, b: np.ndarray, cell: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of pairs of row numbers those that sizes and bitmaps allow, with the bits apart."""
        _, _, n, comp, bits, _, _, wide = cell
        keep = [np.zeros(0, np.int64)] * 3
        widths = np.array([len(w) // 8 for w in wide], np.int64)
        for i in range(0, len(a), 65536):
            x, y = a[i : i + 65536], b[i : i + 65536]
            fits = (comp[x] != comp[y]) & (n[x] * 100 >= n[y] * percent) & (n[y] * 100 >= n[x] * percent)
            x, y = x[fits], y[fits]
            # Bits apart <= true difference = total - 2 * shared, and shared must reach percent * total / (100 + percent).
            far = np.bitwise_count(bits[x] ^ bits[y]).sum(1, dtype=np.int64)
            fits = far * (100 + percent) <= (n[x] + n[y]) * (100 - percent)
            x, y, far = x[fits], y[fits], far[fits]
            words = 2 * _BITS // 64
            while len(x) and (both := np.minimum(widths[x], widths[y]) >= words).any():
                matrix, at = _folded(wide, widths, np.unique(np.concatenate([x[both], y[both]])), words)
                far[both] = np.bitwise_count(matrix[at[x[both]]] ^ matrix[at[y[both]]]).sum(1, dtype=np.int64)
                fits = far * (100 + percent) <= (n[x] + n[y]) * (100 - percent)
                x, y, far, words = x[fits], y[fits], far[fits], 2 * words
            keep = [np.concatenate(z) for z in zip(keep, (x, y, far))]
        return tuple(keep)

    def large(rows: np.ndarray, cell: list[np.ndarray]) -> list[tuple]:
        """All pairs of one large unit of work, a block of left rows at a time."""
        _, _, n, comp, bits, left, right, _ = (c[rows] for c in cell)
        folded = np.bitwise_xor.reduce(bits.reshape(len(rows), -1, 4), axis=1)
        lefts, r, found = np.flatnonzero(left), np.flatnonzero(right), []
        for i in range(0, len(lefts), 256):
            at = lefts[i : i + 256]
            total = n[at][:, None] + n[r][None, :]
            # Both ways round in a unit of one block: one is enough.
            fits = (comp[at][:, None] != comp[r][None, :]) & (~(right[at][:, None] & left[r][None, :]) | (at[:, None] < r[None, :]))
            if not fits.any():
                continue
            allowed = (total * (100 - percent) // (100 + percent)).astype(np.int32)
            apart = np.zeros(fits.shape, np.uint16)
            for w in range(folded.shape[1]):
                apart += np.bitwise_count(folded[at, w][:, None] ^ folded[r, w][None, :])
            x, y = np.nonzero(fits & (apart <= allowed))
            found.append(sound(rows[at[x]], rows[r[y]], cell))
        return found

    def pairs(cell: list[np.ndarray]) -> pa.RecordBatch | None:
        """Pairs of whole units of work, one after the other in ``cell``."""
        keys, ids = cell[0], cell[1]
        cut = np.flatnonzero(np.append(keys[1:] != keys[:-1], True)) + 1
        begin = np.append(0, cut[:-1])
        size = cut - begin
        found = []
        for i in np.flatnonzero(size > 48):
            found += large(np.arange(begin[i], cut[i]), cell)
        # Small units all at once: rows that stand d apart in the same unit.
        inside = np.repeat(np.where(size > 48, 0, cut), size)
        at = np.flatnonzero(inside > np.arange(len(keys)) + 1)
        for d in range(1, 48):
            at = at[at + d < inside[at]]
            if not len(at):
                break
            whole = (cell[5][at] & cell[6][at + d]) | (cell[6][at] & cell[5][at + d])
            found.append(sound(at[whole], at[whole] + d, cell))
        if not found:
            return None
        a, b, far = (np.concatenate(z) for z in zip(*found))
        if not len(a):
            return None
        if nearest:
            both, back = np.concatenate([ids[a], ids[b]]), np.concatenate([ids[b], ids[a]])
            order = np.lexsort((np.tile(far, 2), both))
            one = np.ones(len(both), bool)
            one[1:] = both[order][1:] != both[order][:-1]
            x, y = both[order][one], back[order][one]
            n = np.zeros((2, len(x)), np.int64)
        else:
            x, y, n = ids[a], ids[b], np.stack([cell[2][a], cell[2][b]])
        swap = x > y
        rows = np.stack([np.where(swap, y, x), np.where(swap, x, y), np.where(swap, n[1], n[0]), np.where(swap, n[0], n[1])], axis=1)
        rows, times = np.unique(rows, axis=0, return_counts=True)
        return pa.RecordBatch.from_arrays([*map(pa.array, rows.T), pa.array(times.astype(np.int64))], ["a", "b", "na", "nb", "times"])

    def run(batches):
        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [
                batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().astype(np.int64), batch.column(3).to_numpy(),
                None, batch.column(5).to_numpy(zero_copy_only=False), batch.column(6).to_numpy(zero_copy_only=False),
                np.array([*batch.column(4).to_pylist(), None], object)[:-1],
            ]
            sizes = np.array([len(w) // 8 for w in columns[7]])
            columns[4] = _folded(columns[7], sizes, np.arange(len(sizes)), _BITS // 64)[0]
            held = columns if held is None else [np.concatenate(x) for x in zip(held, columns)]
            last = int(np.searchsorted(held[0], held[0][-1]))  # the last unit may go on in the next batch
            if last and (out := pairs([c[:last] for c in held])):
                yield out
            held = [c[last:] for c in held]
        if held is not None and (out := pairs(held)):
            yield out

    on_workers(keyed.sparkSession)
    met = keyed.mapInArrow(run, "a bigint, b bigint, na bigint, nb bigint, times bigint")
    if nearest:
        return met.select("a", "b").distinct()
    # Shared shingles = those in both prefixes (one list each) + at most what follows the prefix of either.
    shared = met.groupBy("a", "b", "na", "nb").agg(F.sum("times").alias("times"))
    rest = F.ceil(F.greatest("na", "nb") * percent / 100 - 1e-9) - 1
    enough = F.ceil((F.col("na") + F.col("nb")) * percent / (100 + percent) - 1e-9) - rest
    return shared.where((F.least("na", "nb") <= LIGHT_MOST) | (F.col("times") >= enough)).select("a", "b")


def _folded(bitmaps: np.ndarray, widths: np.ndarray, rows: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The bitmaps of ``rows``, folded to ``words`` words each, and where each row stands in that matrix."""
    out = np.zeros((len(rows), words), np.uint64)
    for w in np.unique(widths[rows]).tolist():
        own = np.flatnonzero(widths[rows] == w)
        whole = np.frombuffer(b"".join(bitmaps[rows[own]].tolist()), np.uint64).reshape(len(own), -1, words)
        out[own] = np.bitwise_xor.reduce(whole, axis=1)
    at = np.zeros(len(bitmaps), np.int64)
    at[rows] = np.arange(len(rows))
    return out, at


def verified(pairs: DataFrame, docs: DataFrame, owners: DataFrame, several: bool, k: int, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` of set ids whose texts' sets are similar, by the exact counts.

    ``owners``: a row ``(_key, _tie)`` of ``docs`` for each ``id``; ``several`` if such a row may be repeated.
    """
    ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct().join(owners, "id"), "ngram-ids")
    texts = docs.join(small(ids), ["_key", "_tie"]).select("id", "_text")
    texts = materialize(texts.dropDuplicates(["id"]) if several else texts, "ngram-texts")
    one = pairs.join(texts.select(F.col("id").alias("a"), F.col("_text").alias("_ta")), "a")
    both = one.join(texts.select(F.col("id").alias("b"), F.col("_text").alias("_tb")), "b").select("a", "b", "_ta", "_tb")

    def run(batch: pa.RecordBatch) -> pa.Table:
        sides = []
        for column in (2, 3):
            parts: list[np.ndarray] = []
            for _, made, counts in shingle_sets(batch.column(column), k):
                parts += np.split(made, np.cumsum(counts)[:-1])
            sides.append(parts)
        keep = []
        for x, y in zip(*sides):
            shared = len(x) + len(y) - len(np.union1d(x, y)) if min(len(x), len(y)) * 100 >= max(len(x), len(y)) * percent else 0
            keep.append(100 * shared >= percent * (len(x) + len(y) - shared) and shared > 0)
        return pa.table([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep))

    return map_batches(both, "a bigint, b bigint", run)


def _joined(rows: DataFrame, several: bool, k: int, percent: int) -> DataFrame:
    """Per row of ``rows`` ``(_key, _tie, _text)``: ``_key``, ``_tie``, ``n``, ``component`` and its first row ``first``.

    ``component`` is a number of the component, ``first`` the least ``(_key, _tie)`` in it; both null without a set or key.
    """
    spark = rows.sparkSession
    levels = rarity(rows, k)
    found = document_sets(rows, k, percent, levels).withColumn("row", F.monotonically_increasing_id())
    found = materialize(found, "ngram-rows")  # written, so that the numbers of its rows stay
    member = found.select("_key", "_tie", "f1", "f2", "n")
    solid = found.where("n > 0 AND _key IS NOT NULL")
    classes = solid.groupBy("f1", "f2", "n").agg(F.min(F.struct("_key", "_tie", "row")).alias("one"))
    # A class is one written row, whatever else has its key; the number of that row is its id.
    classes = materialize(classes.select("f1", "f2", "n", F.col("one.row").alias("id"), "one._key", "one._tie"), "ngram-classes")
    sets = found.join(small(classes.select(F.col("id").alias("row"))), "row", "left_semi").select(F.col("row").alias("id"), "n", "tokens", "bits")
    sets = materialize(sets, "ngram-sets")
    sizes = {r["n"]: r["c"] for r in sets.where(F.col("n") <= LIGHT_MOST).groupBy("n").agg(F.count("*").alias("c")).collect()}
    posted = signatures(sets, percent, boundary(sizes, percent))
    shared = posted.groupBy("sig").agg(F.count("*").alias("_n")).where("_n > 1").select("sig")
    lists = materialize(posted.join(shared, "sig", "left_semi"), "ngram-lists")
    texts, owners = rows.where("_key IS NOT NULL"), classes.select("id", "_key", "_tie")
    links, labels = None, None
    for turn in range(ROUNDS + 1):
        last = turn == ROUNDS
        used = lists
        if not last:
            # A share of the lists is enough to find near partners; another share each round.
            used = lists.where(F.pmod(F.xxhash64("sig", F.lit(turn)), F.lit(8)) == 0)

        def found_links() -> DataFrame:
            pairs = materialize(_cells(used, sets, labels, not last, percent), "ngram-pairs")
            return verified(pairs, texts, owners, several, k, percent)

        new = settled(spark, "ngram-links", found_links)
        links = new if links is None else links.union(new)
        if labels is None or last or new.limit(1).count():
            labels = settled(spark, "ngram-components", lambda: components(links))
    # Ids are row numbers: the least key of a component is taken from its classes.
    linked = materialize(labels.join(classes.select("id", "_key", "_tie"), "id"), "ngram-linked")
    least = linked.groupBy("component").agg(F.min(F.struct("_key", "_tie")).alias("first"))
    linked = linked.select("id", "component").join(least, "component")
    own = F.struct("_key", "_tie")
    placed = classes.join(linked, "id", "left").select("f1", "f2", "n", F.coalesce("component", "id").alias("component"), F.coalesce("first", own).alias("first"))
    whole = member.join(placed, ["f1", "f2", "n"], "left")
    solid = F.col("_key").isNotNull() & (F.col("n") > 0)
    return whole.select("_key", "_tie", "n", F.when(solid, F.col("component")).alias("component"), F.when(solid, F.col("first")).alias("first"))


def similar_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 75) -> DataFrame:
    """One row per row of ``docs``: key, ``n_shingles``, ``component_id`` (least key reachable by links).

    Keys are integers. A null text is empty; empty sets link with nothing and
    are components of their own. Rows of one key with different texts are
    documents of their own, linked only if their sets are; a null key takes no
    part and has a null component. Other columns are not read.
    """
    rows, several = told_apart(docs.select(F.col(f"`{key}`").cast("long").alias("_key"), F.col(f"`{text}`").alias("_text")))
    found = settled(docs.sparkSession, "ngram-found", lambda: _joined(rows, several, k, percent))
    return found.select(
        F.col("_key").alias(key), F.col("n").cast("long").alias("n_shingles"), F.coalesce("first._key", "_key").alias("component_id")
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", k: int = 5, percent: int = 75) -> DataFrame:
    """The document with the least key of each component (then the least hash of its text), all columns as they are.

    Rows with a null key stay, documents without words stay; of several rows
    of one key and text that have words one stays, whichever.
    """
    own = {c: {key: "_id", text: "_text"}.get(c, f"_c{i}") for i, c in enumerate(docs.columns)}
    keyed = docs.select(*[F.col(f"`{c}`").alias(a) for c, a in own.items()]).withColumn("_key", F.col("_id").cast("long"))
    rows, several = told_apart(keyed)
    found = settled(docs.sparkSession, "ngram-found", lambda: _joined(rows.select("_key", "_tie", "_text"), several, k, percent))
    names = ["_key", "_tie"]
    dropped = found.where(F.col("first") != F.struct("_key", "_tie")).select(*names).distinct()
    kept = rows.join(small(materialize(dropped, "ngram-dropped")), names, "left_anti")
    if several:
        # Counted over rows with words only; the rest of a repeated row stays as it is.
        twice = found.where("first IS NOT NULL").groupBy(*names).agg(F.count("*").alias("_n")).where("_n > 1").select(*names)
        twice = materialize(twice, "ngram-twice")
        once = kept.join(small(twice), names, "left_semi").dropDuplicates(names)
        kept = kept.join(small(twice), names, "left_anti").unionByName(once)
    return kept.select(*[F.col(a).alias(c) for c, a in own.items()])
