"""SentencePiece unigram encoding and decoding: Viterbi over a double-array trie of pieces.

Pieces and their log scores come from a SentencePiece model file, whose path is a
parameter; nothing is trained. Spaces become the marker U+2581 and one stands
before the text. The best path adds the scores of its pieces; a character that no
piece covers costs the least score less ``UNKNOWN`` and is written as its UTF-8
bytes. Decoding joins pieces and bytes, turns markers into spaces and drops the
first; bytes that are no UTF-8 become U+FFFD.

A text is cut where no piece can cross, found from the pieces themselves, so the
best path of the text is that of its parts, one after another; parts that come
again are looked up in a bounded memo.

Defined results: a null or empty text has no ids and decodes to an empty text; a
marker in the text decodes to a space; everything else comes back as it was.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.worker import held, packed_with, texts_of

MARK = "▁"
UNKNOWN = 10.0
MEMO = 600_000
STRETCH = 1_000_000
PARTS_AT_ONCE = 8192
LONGEST_IN_MEMO = 48
#: Kinds of a piece in the file format: ordinary, and one byte.
NORMAL, BYTE = 1, 6


class DoubleArray:
    """Trie over UTF-8 bytes in two arrays: state ``s`` goes by byte ``c`` to ``base[s] + c + 1`` if ``check`` there is ``s``."""

    def __init__(self, keys: dict[bytes, int]):
        tree: dict = {}
        for key, value in keys.items():
            node = tree
            for byte in key:
                node = node.setdefault(byte, {})
            node[-1] = value
        self.base, self.check, self.value = [0] * 512, [-1] * 512, [-1] * 512
        self.check[0] = 0
        free, todo = 1, [(0, tree)]
        while todo:
            state, node = todo.pop()
            self.value[state] = node.get(-1, -1)
            bytes_ = sorted(b for b in node if b >= 0)
            if not bytes_:
                continue
            while self.check[free] != -1:
                free += 1
                self._grow(free)
            base, tries = max(0, free - bytes_[0] - 1), 0
            self._grow(base + 257)
            while any(self.check[base + b + 1] != -1 for b in bytes_):
                base, tries = base + 1, tries + 1
                self._grow(base + 257)
            if tries > 16:  # what lies before is nearly full: begin here next time
                free = base
            self.base[state] = base
            for b in bytes_:
                self.check[base + b + 1] = state
                todo.append((base + b + 1, node[b]))

    def _grow(self, size: int) -> None:
        if size >= len(self.check):
            extra = max(size + 1 - len(self.check), len(self.check))
            self.base += [0] * extra
            self.check += [-1] * extra
            self.value += [-1] * extra


def _part_pattern(pieces: list[str]) -> re.Pattern:
    """Cuts a marked text only where no piece can cross.

    Pieces hold a marker at their start or in runs of markers, never after another
    character; no piece holds a line end; and none goes on to a comma or full stop
    from a character outside ``before``. Were a model to break the first, its texts
    stay in one part.
    """
    pairs = {pair for p in pieces for pair in zip(p, p[1:], strict=False)}
    if any(b == MARK and a != MARK for a, b in pairs):
        return re.compile(r"[\s\S]+")
    before = re.escape("".join(sorted({a for a, b in pairs if b in ".,"} | set(MARK + ".,\n"))))
    line = "" if any("\n" in p for p in pieces) else r"\n"
    lines = rf"{line}+|" if line else ""
    return re.compile(rf"{lines}{MARK}*[^{MARK}.,\n]*[^{before}](?=[.,])|{MARK}*[^{MARK}{line}]+|{MARK}+")


class Unigram:
    """Encoder and decoder over ``pieces``, a list of (text, score, kind) whose places are the ids."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        self.pieces = pieces
        self.scores = [p[1] for p in pieces]
        normal = {p[0].encode(): i for i, p in enumerate(pieces) if p[2] == NORMAL}
        self.trie = DoubleArray(normal)
        self.byte_ids = {int(p[0][3:5], 16): i for i, p in enumerate(pieces) if p[2] == BYTE}
        self.unknown = min((self.scores[i] for i in normal.values()), default=0.0) - UNKNOWN
        self.spelled = [bytes([int(p[0][3:5], 16)]) if p[2] == BYTE else p[0].replace(MARK, " ").encode() if p[2] == NORMAL else b"" for p in pieces]
        self.parts = _part_pattern([p[0] for p in pieces if p[2] == NORMAL])
        self.splits = not self.parts.fullmatch(f"a{MARK}a")  # a marker begins a new part
        self.memo: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self.arrays = [np.array(x, dtype=np.int32) for x in (self.trie.base, self.trie.check, self.trie.value)]
        self.score_array = np.array(self.scores)

    def best(self, part: str) -> list[int]:
        """Ids of the best path; of equal paths, the one whose last piece starts first."""
        data = part.encode()
        size, worst = len(data), float("-inf")
        total, start, piece = [worst] * (size + 1), [0] * (size + 1), [-1] * (size + 1)
        total[0], at = 0.0, 0
        scores, base, check, value = self.scores, self.trie.base, self.trie.check, self.trie.value
        while at < size:
            lead = data[at]
            next_char = at + (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4)
            here, state, single = total[at], 0, False
            for end in range(at, size):
                to = base[state] + data[end] + 1
                if check[to] != state:
                    break
                state, found = to, value[to]
                if found >= 0:
                    score, stop = here + scores[found], end + 1
                    single |= stop == next_char
                    if score > total[stop]:
                        total[stop], start[stop], piece[stop] = score, at, found
            if not single and here + self.unknown > total[next_char]:
                total[next_char], start[next_char], piece[next_char] = here + self.unknown, at, -1
            at = next_char
        ids: list[int] = []
        while at:
            begin = start[at]
            ids.extend([piece[at]] if piece[at] >= 0 else [self.byte_ids[b] for b in reversed(data[begin:at])])
            at = begin
        return ids[::-1]

    def best_many(self, parts: list[str]) -> list[list[int]]:
        """:meth:`best` of many short parts at once, one step of all their tries at a time."""
        coded = [p.encode() for p in parts]
        lens = np.array([len(c) for c in coded])
        n, longest = len(coded), int(lens.max())
        data = np.frombuffer(b"".join(c.ljust(longest, b"\0") for c in coded), dtype=np.uint8).reshape(n, longest).T.astype(np.int32)
        step = np.where(data < 0x80, 1, np.where(data < 0xE0, 2, np.where(data < 0xF0, 3, 4)))
        total = np.full((longest + 1, n), -np.inf)
        start, piece = np.zeros((longest + 1, n), dtype=np.int64), np.full((longest + 1, n), -1, dtype=np.int64)
        total[0] = 0.0
        base, check, value = self.arrays
        for at in range(longest):
            rows = np.flatnonzero((lens > at) & (total[at] > -np.inf))
            if not len(rows):
                continue
            live, state, single = rows, np.zeros(len(rows), dtype=np.int32), np.zeros(n, dtype=bool)
            for end in range(at, longest):
                to = base[state] + data[end, live] + 1
                on = (check[to] == state) & (lens[live] > end)
                live, state = live[on], to[on]
                if not len(live):
                    break
                found = value[state]
                hit, found = live[found >= 0], found[found >= 0]
                score, stop = total[at, hit] + self.score_array[found], end + 1
                single[hit[at + step[at, hit] == stop]] = True
                better = score > total[stop, hit]
                hit = hit[better]
                total[stop, hit], start[stop, hit], piece[stop, hit] = score[better], at, found[better]
            bare = rows[~single[rows]]
            stop, score = at + step[at, bare], total[at, bare] + self.unknown
            better = score > total[stop, bare]
            bare, stop = bare[better], stop[better]
            total[stop, bare], start[stop, bare], piece[stop, bare] = score[better], at, -1
        out = []
        for k, (begins, ids_at) in enumerate(zip(start.T.tolist(), piece.T.tolist(), strict=True)):
            at, ids = len(coded[k]), []
            while at:
                begin = begins[at]
                ids.extend([ids_at[at]] if ids_at[at] >= 0 else [self.byte_ids[b] for b in reversed(coded[k][begin:at])])
                at = begin
            out.append(ids[::-1])
        return out

    def _learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of marked words that the memo lacks, from their parts; too long words are returned and not kept."""
        cut = {w: self.parts.findall(MARK + w) for w in words}
        heads, tails = self.memo, self.tails
        new = {p for parts in cut.values() for p in parts if (p[1:] not in heads if p[0] == MARK else p not in tails)}
        short, found = sorted((p for p in new if len(p) <= LONGEST_IN_MEMO), key=len), {}
        for at in range(0, len(short), PARTS_AT_ONCE):  # parts of about one length, so tables have little padding
            some = short[at : at + PARTS_AT_ONCE]
            found.update(zip(some, self.best_many(some), strict=True))
        found.update((p, self.best(p)) for p in new if len(p) > LONGEST_IN_MEMO)
        coded = {p: np.array(ids, dtype="<i4").tobytes() for p, ids in found.items()}
        for p, ids in coded.items():
            if len(p) <= LONGEST_IN_MEMO:
                if p[0] != MARK:
                    tails[p] = ids
                elif MARK not in p[1:]:
                    heads[p[1:]] = ids
        once = {}
        for w, parts in cut.items():
            if w not in heads:
                ids = b"".join([coded[p] if p in coded else heads[p[1:]] if p[0] == MARK else tails[p] for p in parts])
                (heads if len(w) <= LONGEST_IN_MEMO and MARK not in w else once)[w] = ids
        return once

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text, worked through in stretches of about ``STRETCH`` characters.

        Single spaces part words, each of which stands for a marker and the word. Where
        spaces come in runs, or a text holds a marker itself, the text is one word.
        """
        out: list[np.ndarray] = []
        at = 0
        while at < len(texts):
            cut, chars = [], 0
            while at < len(texts) and (not cut or chars < STRETCH):
                text = texts[at] or ""
                runs = "  " in text or text[:1] == " " or text[-1:] == " " or MARK in text
                cut.append([] if not text else [text.replace(" ", MARK)] if runs or not self.splits else text.split(" "))
                chars, at = chars + len(text), at + 1
            if len(self.memo) + len(self.tails) > MEMO:
                self.memo.clear()
                self.tails.clear()
            known = self.memo
            new = set().union(*cut).difference(known)
            once = self._learn(new) if new else {}
            look = (lambda w: once[w] if w in once else known[w]) if once else known.__getitem__  # noqa: B023
            out.extend(np.frombuffer(b"".join(map(look, words)), dtype="<i4") for words in cut)
        return out

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        spelled = self.spelled
        text = b"".join([spelled[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


def read_pieces(path: str) -> list[tuple[str, float, int]]:
    """Pieces of a model file, in id order."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    kind = lambda i: BYTE if model.is_byte(i) else NORMAL if not (model.is_control(i) or model.is_unknown(i)) else 0
    return [(model.id_to_piece(i), model.get_score(i), kind(i)) for i in range(model.get_piece_size())]


def load(path: str) -> Unigram:
    """One model per worker process."""
    return held(("unigram", path), lambda: Unigram(read_pieces(path)))


def slices(batch: pa.RecordBatch, column: int | pa.Array) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows of a batch with about ``STRETCH`` bytes in the column, or one row with more."""
    texts = batch.column(column) if isinstance(column, int) else column
    sizes = np.array(pa.compute.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        stop = max(at + 1, int(np.searchsorted(ends, ends[at] - sizes[at] + STRETCH, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def encode_decode(docs: DataFrame, model: str, text: str = "text", keep: list[str] | None = None, decode: bool = True) -> DataFrame:
    """``keep`` columns of ``docs`` as a struct ``_row``, ``ids`` and, with ``decode``, the text ``decoded`` from them.

    Batches go in slices, so a task holds words and ids of one stretch or one text, not of a batch.
    """
    keep = docs.columns if keep is None else keep
    packed = packed_with(docs, keep, text)
    names = ["_row", "ids", "decoded"][: 2 + decode]
    schema = packed.select("_row", F.array().cast("array<int>").alias("ids"), F.lit("").alias("decoded")).select(*names).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unigram = load(model)
        for batch in (part for whole in batches for part in slices(whole, texts_of(whole, text))):
            ids = unigram.encode_all(texts_of(batch, text).to_pylist())
            ends = np.cumsum([0, *map(len, ids)], dtype=np.int32)
            flat = np.concatenate(ids) if ids else np.array([], dtype=np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32, copy=False)))
            columns = [batch.column(0), lists]
            if decode:
                columns.append(pa.array([unigram.decode(x) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return packed.mapInArrow(run, schema)
