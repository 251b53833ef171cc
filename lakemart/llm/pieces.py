"""The vocabulary of a SentencePiece byte-pair model, as the operators use it."""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import lru_cache

SPACE = "▁"


@dataclass(frozen=True)
class Vocabulary:
    """``rank`` orders merges: of all adjacent pairs that join to a piece, the lowest goes first.

    ``pieces`` holds the normal pieces only; a character outside it is spelled
    with the byte pieces (``byte_ids``).
    """

    pieces: dict[str, int]
    rank: dict[str, float]
    byte_ids: list[int]
    texts: list[bytes]
    size: int


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    size = sp.vocab_size()
    pieces, rank, byte_ids, texts = {}, {}, [0] * 256, [b""] * size
    for i in range(size):
        piece = sp.id_to_piece(i)
        if sp.is_byte(i):
            value = int(piece[1:-1], 16)
            byte_ids[value], texts[i] = i, bytes([value])
        elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
            pieces[piece], rank[piece], texts[i] = i, -sp.get_score(i), piece.replace(SPACE, " ").encode()
    inside = [p for p in pieces if SPACE in p.lstrip(SPACE)]
    alone = {c for p in pieces for c in p} - pieces.keys()
    if inside or alone:
        raise ValueError("pieces with an inner word start, or of characters outside the vocabulary, are not supported")
    return Vocabulary(pieces, rank, byte_ids, texts, size)


def chunks(text: str) -> list[str]:
    """The text cut before each word start, without the one space that begins every chunk.

    The model puts a space before the text, and no piece goes over a word
    start, so chunks are merged apart from each other. Further spaces of a run
    stand at the front of the next chunk.
    """
    text = text.replace(SPACE, " ")
    if not text:
        return []
    words = text.split(" ")
    if "" not in words:
        return words
    out, run = [], 0
    for word in words[:-1]:
        if word:
            out.append(" " * run + word)
            run = 0
        else:
            run += 1
    out.append(" " * run + words[-1])
    return out


def merge(symbols: str, rank: dict[str, float]) -> list[str]:
    """Byte-pair merging of one chunk with a heap of pairs over a linked list of symbols.

    The lowest rank is popped first, the leftmost of equals; an entry whose
    symbols have changed since is passed over.
    """
    n = len(symbols)
    part: list[str | None] = list(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        pair = symbols[i : i + 2]
        if pair in rank:
            heap.append((rank[pair], i, pair))
    heapq.heapify(heap)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i]
        if part[i] is None or j >= n or len(part[i]) + len(part[j]) != len(pair):
            continue
        part[i], part[j] = pair, None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            new = pair + part[k]
            if new in rank:
                heapq.heappush(heap, (rank[new], i, new))
        h = before[i]
        if h >= 0:
            new = part[h] + pair
            if new in rank:
                heapq.heappush(heap, (rank[new], h, new))
    return [p for p in part if p is not None]
