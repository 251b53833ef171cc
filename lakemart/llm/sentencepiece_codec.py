"""SentencePiece encoding by suffix-array matching and relaxation; decoding.

The chunks of a batch are joined to one text of character codes. Its suffix
array, sorted to the depth of the longest piece, gives every piece's
occurrences as one range found by binary search. The occurrences are edges
(start, end, piece); sorted by end position inside the chunk, they are relaxed
for all chunks at once. For a byte-pair model exactly one piece can end the
encoding of each prefix: the one that stands unmerged beside the last piece of
the prefix before it. That test is local to two pieces and is remembered, so
the path found is the model's own encoding.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import map_batches
from lakemart.llm.pieces import SPACE, Vocabulary, chunks, merge, vocabulary

#: New characters whose suffixes are sorted at a time, characters of text cut at a time, rows of a batch worked
#: on at a time, and chunks a worker remembers; none changes a result.
BLOCK_CHARS = 1 << 18
TEXT_CHARS = 1 << 21
ROWS = 512
REMEMBERED = 600_000
_DEPTH = 16


def _packed(codes: np.ndarray) -> np.ndarray:
    """Four 16-bit codes in each of four words, in the order of comparison."""
    out = np.zeros((_DEPTH // 4, codes.shape[0]), np.uint64)
    for d in range(_DEPTH):
        out[d // 4] = (out[d // 4] << np.uint64(16)) | codes[:, d].astype(np.uint64)
    return out


def _windows(codes: np.ndarray) -> np.ndarray:
    """The packed words of the ``_DEPTH`` codes from each place on; past the end the codes are 0."""
    wide = np.zeros(len(codes) + _DEPTH, np.uint64)
    wide[: len(codes)] = codes
    four = wide[:-3].copy()
    for d in range(1, 4):
        four = (four << np.uint64(16)) | wide[d : len(wide) - 3 + d]
    return np.stack([four[d : d + len(codes)] for d in range(0, _DEPTH, 4)])


@dataclass
class Matcher:
    """The pieces of a vocabulary as sorted code strings, and the pairs tested so far."""

    vocab: Vocabulary
    code: dict[str, int] = field(init=False)
    low: np.ndarray = field(init=False)
    high: np.ndarray = field(init=False)
    ids: np.ndarray = field(init=False)
    length: np.ndarray = field(init=False)
    names: dict[int, str] = field(init=False)
    pairs: np.ndarray = field(init=False)
    stands: np.ndarray = field(init=False)

    def __post_init__(self):
        whole = [p for p in self.vocab.pieces if merge(p, self.vocab.rank) == [p]]
        if max(map(len, whole)) > _DEPTH:
            raise ValueError(f"pieces of over {_DEPTH} characters are not supported")
        letters = sorted({c for p in whole for c in p})
        if len(letters) > 65_000:
            raise ValueError("more characters than codes")
        self.code = {c: i + 1 for i, c in enumerate(letters)}
        table = np.zeros((len(whole), _DEPTH), np.uint16)
        for i, p in enumerate(whole):
            table[i, : len(p)] = [self.code[c] for c in p]
        self.length = np.array([len(p) for p in whole])
        self.ids = np.array([self.vocab.pieces[p] for p in whole])
        self.names = {self.vocab.pieces[p]: p for p in whole}
        self.low = _packed(table)
        table[np.arange(_DEPTH) >= self.length[:, None]] = 0xFFFF
        self.high = _packed(table)
        self.pairs, self.stands = np.zeros(0, np.int64), np.zeros(0, bool)
        self.by_point = np.zeros(0x110000, np.uint16)
        for c, i in self.code.items():
            self.by_point[ord(c)] = i

    def _bounds(self, keys: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
        """For each wanted key the first row of the sorted keys at or (``after``) past it."""
        low, high = np.zeros(wanted.shape[1], np.int64), np.full(wanted.shape[1], keys.shape[1], np.int64)
        while (live := low < high).any():
            at = np.flatnonzero(live)
            mid = (low[at] + high[at]) // 2
            less, same = np.zeros(len(at), bool), np.ones(len(at), bool)
            for k, w in zip(keys, wanted):
                x, y = k[mid], w[at]
                less |= same & (x < y)
                same &= x == y
            go = less | same if after else less
            low[at[go]] = mid[go] + 1
            high[at[~go]] = mid[~go]
        return low

    def _stand(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Which pairs of neighbouring pieces merging leaves as they are."""
        wanted = first.astype(np.int64) * self.vocab.size + second
        distinct, back = np.unique(wanted, return_inverse=True)
        at = np.searchsorted(self.pairs, distinct)
        known = np.zeros(len(distinct), bool)
        if len(self.pairs):
            known = self.pairs[np.minimum(at, len(self.pairs) - 1)] == distinct
        result = np.zeros(len(distinct), bool)
        if known.any():
            result[known] = self.stands[at[known]]
        new = np.flatnonzero(~known)
        if len(new):
            for i in new:
                a, b = (self.names[int(x)] for x in divmod(int(distinct[i]), self.vocab.size))
                result[i] = merge(a + b, self.vocab.rank) == [a, b]
            if len(self.pairs) > 4_000_000:
                self.pairs, self.stands = np.zeros(0, np.int64), np.zeros(0, bool)
            pairs = np.concatenate([self.pairs, distinct[new]])
            order = np.argsort(pairs, kind="stable")
            self.pairs, self.stands = pairs[order], np.concatenate([self.stands, result[new]])[order]
        return result[back]

    def encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all chunks, spelled with the word-start character, one after the other, and where each chunk's
        begin, with the end at last; -1 - code point for a stranger."""
        text = "\x00".join(words) + "\x00" * _DEPTH
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        codes = self.by_point[points]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        begin = np.concatenate([[0], np.cumsum(lengths[:-1] + 1)])
        owner = np.repeat(np.arange(len(words)), lengths + 1)  # each separator goes with the chunk before it
        places = np.delete(np.arange(len(owner)), begin + lengths)  # without the separators
        keys = _windows(codes)[:, places]
        # A code of 0 ends every match: separators and strangers are in no piece.
        suffix = np.lexsort(keys[::-1])
        keys = keys[:, suffix]
        first, last = self._bounds(keys, self.low, False), self._bounds(keys, self.high, True)
        hits = last - first
        piece = np.repeat(np.arange(len(hits)), hits)
        start = places[suffix[np.repeat(first - np.cumsum(hits) + hits, hits) + np.arange(hits.sum())]]
        strange = places[codes[places] == 0]
        ident = np.concatenate([self.ids[piece], -1 - points[strange].astype(np.int64)])
        end = np.concatenate([start + self.length[piece], strange + 1])
        start = np.concatenate([start, strange])
        # Edges by end position inside their chunk, then relaxed one position at a time for all chunks.
        depth = end - begin[owner[start]]
        order = np.argsort(depth, kind="stable")
        start, end, ident, depth = start[order], end[order], ident[order], depth[order]
        none, free = np.iinfo(np.int64).min, np.iinfo(np.int64).max
        best = np.full(len(points) + 1, none)
        origin = np.zeros(len(points) + 1, np.int64)
        best[begin] = free  # a chunk end is never another chunk's beginning: the separator lies between
        cut = np.flatnonzero(np.diff(depth, prepend=-1))
        for i, j in zip(cut, np.append(cut[1:], len(depth))):
            s, e, t = start[i:j], end[i:j], ident[i:j]
            p = best[s]
            ok = p != none
            test = np.flatnonzero(ok & (p >= 0) & (p != free) & (t >= 0))
            ok[test] = self._stand(p[test], t[test])
            best[e[ok]], origin[e[ok]] = t[ok], s[ok]
        # Back along the path, all chunks at once.
        at, home = begin + lengths, np.arange(len(words))
        found, whose = [], []
        while len(at):
            found.append(best[at])
            whose.append(home)
            at = origin[at]
            more = at > begin[home]
            at, home = at[more], home[more]
        found, whose = np.concatenate(found[::-1]), np.concatenate(whose[::-1])
        order = np.argsort(whose, kind="stable")
        return found[order], np.append(0, np.cumsum(np.bincount(whose, minlength=len(words))))


@lru_cache(maxsize=2)
def matcher(model: str) -> Matcher:
    return Matcher(vocabulary(model))


_known: dict[str, dict[str, bytes]] = {}


def _learn(words: list[str], model: str, into: dict[str, bytes]) -> None:
    m = matcher(model)
    ids, cuts = m.encode([SPACE + w.replace(" ", SPACE) for w in words])
    raw, at = ids.astype("<i4").tobytes(), (cuts * 4).tolist()
    for word, i, j in zip(words, at, at[1:]):
        into[word] = raw[i:j]
    strange = np.searchsorted(cuts, np.flatnonzero(ids < 0), side="right") - 1
    for k in np.unique(strange).tolist():
        spelled = []
        for i in ids[cuts[k] : cuts[k + 1]].tolist():
            spelled += [i] if i >= 0 else [m.vocab.byte_ids[b] for b in chr(-1 - i).encode()]
        into[words[k]] = np.array(spelled, "<i4").tobytes()


def encode_texts(texts: list[str], model: str, block: int = BLOCK_CHARS, remembered: int = REMEMBERED) -> list[bytes]:
    """Little-endian int32 ids of each text, as the model gives them without begin or end."""
    known = _known.setdefault(model, {})
    out, at = [], 0
    while at < len(texts):
        if len(known) > remembered:
            known.clear()
        # As many texts as bring one block of new chunks; a long text is one block of its own.
        cut, new, size, total, upto = [], {}, 0, 0, at
        while upto < len(texts) and (upto == at or size < block and total < TEXT_CHARS):
            cut.append(chunks(texts[upto]))
            total += len(texts[upto])
            for chunk in cut[-1]:
                if chunk not in known and chunk not in new:
                    new[chunk] = None
                    size += len(chunk) + 2
            upto += 1
        if new:
            _learn(list(new), model, known)
        out += [b"".join([known[c] for c in part]) for part in cut]
        at = upto
    return out


def decode_ids(ids: bytes, model: str) -> str:
    """Text of little-endian int32 ids: pieces and bytes joined, less the space before the text."""
    pieces = vocabulary(model).texts
    text = b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<i4").tolist())).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


def encode(
    docs: DataFrame, model: str, text: str = "text", out: str = "piece_ids", block: int = BLOCK_CHARS, remembered: int = REMEMBERED
) -> DataFrame:
    """``docs`` with its text encoded: all columns stay, ``out`` (binary, little-endian int32 ids) is added or replaced.

    A null text gives null ids, an empty one empty ids. Rows are taken as they
    come (ties and repeats stay); one pass, no shuffle. ``block`` bounds the
    characters matched at a time, ``remembered`` the chunks a worker remembers:
    less of them takes less memory and more time, with the same ids.
    """
    rows = docs.drop(out)
    at = rows.columns.index(text)
    schema = rows.withColumn(out, F.lit(None).cast("binary")).schema

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).to_pylist()
        ids = iter(encode_texts([t for t in texts if t is not None], model, block, remembered))
        column = pa.array([None if t is None else next(ids) for t in texts], pa.binary())
        return pa.RecordBatch.from_arrays([*batch.columns, column], [*batch.schema.names, out])

    return map_batches(rows, schema, run, ROWS)


def decode(encoded: DataFrame, model: str, ids: str = "piece_ids", text: str = "text") -> DataFrame:
    """Ids back to text, in column ``text`` (added or replaced); the ids column goes. Null ids give a null text.

    The text is the one encoded, but for the character U+2581, which the model
    reads as a space.
    """
    rows = encoded.drop(text)
    at = rows.columns.index(ids)
    rest = [c for c in rows.columns if c != ids]
    schema = rows.select(*[F.col(f"`{c}`") for c in rest]).withColumn(text, F.lit(None).cast("string")).schema

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        column = pa.array([None if i is None else decode_ids(i, model) for i in batch.column(at).to_pylist()], pa.string())
        kept = [batch.column(i) for i, n in enumerate(batch.schema.names) if i != at]
        return pa.RecordBatch.from_arrays([*kept, column], [*rest, text])

    return map_batches(rows, schema, run, ROWS)


def digest(encoded: DataFrame, model: str, key: str = "doc_id", text: str = "text", ids: str = "piece_ids") -> DataFrame:
    """Key, ``n_pieces``, ``ids_sha256`` (of the int32 ids), ``round_trip``: decoding gives the text back."""
    rows = encoded.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_t"), F.col(f"`{ids}`").alias("_i"))
    kind = rows.schema["_key"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, shas, same = [], [], []
        for t, i in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            i, t = i or b"", t or ""
            counts.append(len(i) // 4)
            shas.append(hashlib.sha256(i).hexdigest())
            same.append(decode_ids(i, model) == t.replace(SPACE, " "))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(counts, pa.int64()), pa.array(shas), pa.array(same)],
            ["_key", "n_pieces", "ids_sha256", "round_trip"],
        )

    made = map_batches(rows, f"_key {kind}, n_pieces bigint, ids_sha256 string, round_trip boolean", run, ROWS)
    return made.withColumnRenamed("_key", key)
