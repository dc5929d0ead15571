"""SentencePiece encoding and decoding for merge-type vocabularies.

Encoding keeps an agenda of adjacent symbol pairs whose concatenation is a piece, and again and
again merges the pair of highest score, the leftmost among equals. No piece of such a vocabulary
holds the space mark after another character, so no merge crosses the start of a space run: a text
falls into chunks, each with an agenda of its own. Short chunks are merged many at a time (a matrix
of pair scores is the agenda of each row); long ones with a heap. The ids of short chunks are kept
in a store of bounded size. Characters without a piece fall back to bytes, else to the unknown id.

In every Arrow batch the sentencepiece library is asked about every whole text before its ids are handed
out, so about every chunk of it, new or kept; any difference raises. Models whose pieces or normalisation would not allow chunks (other
than spaces to marks with a mark in front) are refused when they are loaded.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .shared import give_back, worker_stores
from .textbytes import slices

MARK = "▁"
SHORT = 48  # characters of a chunk that the matrix form takes and the store keeps
CACHE = 500_000  # chunks kept at most: a string of SHORT characters, a place and its ids, about 80 MB a worker, 160 MB at the worst
PROBES = ("a b", " a  b ", "\ufb01 \u2460 e\u0301 \u00e9 \uff21\t\u3000x")  # what other normalisations change
SLICE = 2 << 20  # bytes of text encoded together
GROUP = 16_384  # short chunks merged together
_RUNS = re.compile(" *[^ ]+| +").findall


class PieceModel:
    """A merge-type model file, its pair table and the agenda encoder."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        n = len(sp)
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) for i in range(n)]
        self.piece_id = {sp.id_to_piece(i): i for i in range(n) if not special[i]}
        if any(MARK in p.lstrip(MARK) for p in self.piece_id):
            raise ValueError("a piece holds a space mark after another character: chunks would not be independent")
        if any(sp.normalize(t) != MARK + t.replace(" ", MARK) for t in PROBES):
            raise ValueError("the model normalises texts: chunks of the text itself would not be what it encodes")
        self.byte_id = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        self.unknown = sp.unk_id()
        # symbols: pieces, then single characters that occur only inside pieces, then all others
        self.symbols = list(self.piece_id) + sorted({c for p in self.piece_id for c in p} - self.piece_id.keys())
        number = {s: i for i, s in enumerate(self.symbols)}
        self.other = len(self.symbols)
        self.of_char = np.full(0x110000, self.other, np.int32)
        for s, i in number.items():
            if len(s) == 1:
                self.of_char[ord(s)] = i
        self.of_char[ord(" ")] = self.of_char[ord(MARK)]
        self.score = np.array([sp.get_score(self.piece_id[s]) if s in self.piece_id else -np.inf for s in self.symbols])
        left, right, whole = [], [], []
        for s, i in number.items():
            for cut in range(1, len(s)):
                a, b = number.get(s[:cut]), number.get(s[cut:])
                if a is not None and b is not None:
                    left.append(a), right.append(b), whole.append(i)
        self._index(np.array(left, np.uint64), np.array(right, np.uint64), np.array(whole, np.int32))
        self.ids = [(self.piece_id[s],) if s in self.piece_id else self._bytes(s) for s in self.symbols]
        self.plain_id = np.array([*(self.piece_id.get(s, -2) for s in self.symbols), -2, -1], np.int32)  # the last is for index -1
        self.text_of_id = [str(i) for i in range(n)]
        self.kept = _Kept()

    def _bytes(self, char: str) -> tuple[int, ...]:
        raw = char.encode("utf-8", "surrogatepass")
        return tuple(self.byte_id[b] for b in raw) if self.byte_id else (self.unknown,)

    def _index(self, left: np.ndarray, right: np.ndarray, whole: np.ndarray) -> None:
        """An open-addressing table from a pair of symbols to the symbol that joins them."""
        self.bits = max(10, int(len(left) * 6).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys, self.values = np.full(1 << self.bits, -1, np.int64), np.full(1 << self.bits, -1, np.int32)
        wanted = ((left << np.uint64(32)) | right).astype(np.int64)
        slot = self._slot(wanted)
        while len(wanted):
            free = self.keys[slot] == -1
            first = np.zeros(len(slot), bool)
            first[np.unique(slot, return_index=True)[1]] = True
            put = free & first
            self.keys[slot[put]], self.values[slot[put]] = wanted[put], whole[put]
            wanted, whole, slot = wanted[~put], whole[~put], (slot[~put] + 1) & self.mask

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The symbol of each pair, or -1."""
        key = (left.astype(np.int64) << 32) | right.astype(np.int64)
        slot = self._slot(key)
        out, found = np.full(len(key), -1, np.int32), self.keys[slot]
        hit = found == key
        out[hit] = self.values[slot[hit]]
        open_ = np.flatnonzero(~hit & (found != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self.mask
            found = self.keys[slot[open_]]
            hit = found == key[open_]
            out[open_[hit]] = self.values[slot[open_[hit]]]
            open_ = open_[~hit & (found != -1)]
        return out

    def _ranks(self) -> np.ndarray:
        """The place of each symbol's score among all, -1 if it has none; the last is for index -1."""
        return np.append(np.where(self.score > -np.inf, np.unique(self.score, return_inverse=True)[1], -1), -1).astype(np.int32)

    def _matrix(self, chunks: list[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
        """Agendas of many short chunks at once: (chunks, their numbers of ids, all ids) by groups of alike length."""
        rank = self._ranks()
        order = sorted(chunks, key=len)  # without their first space
        for lo in range(0, len(order), GROUP):
            part = order[lo : lo + GROUP]
            lengths, width = np.fromiter(map(len, part), np.int64, len(part)) + 1, max(2, len(part[-1]) + 1)
            codes = np.frombuffer((" " + " ".join(part)).encode("utf-32-le", "surrogatepass"), np.uint32)
            rows = np.full((len(part), width), -1, np.int32)
            rows[np.arange(width) < lengths[:, None]] = self.of_char[codes]
            symbols = np.ascontiguousarray(rows.T)  # a row for each place: what follows goes through whole rows
            pairs = np.full((width - 1, len(part)), -1, np.int32)
            both = symbols[1:] >= 0
            pairs[both] = self.joined(symbols[:-1][both], symbols[1:][both])
            symbols = self._merge(symbols, rank[pairs], rank).T
            plain = self.plain_id[symbols]  # -1: a free cell, -2: a character without a piece
            odd = (plain == -2).any(1)
            yield [c for c, x in zip(part, odd.tolist(), strict=True) if not x], (plain >= 0).sum(1)[~odd], plain[~odd][plain[~odd] >= 0]
            if odd.any():
                ids = [self._ids(" " + part[i], symbols[i].tolist()) for i in np.flatnonzero(odd).tolist()]
                yield [part[i] for i in np.flatnonzero(odd).tolist()], np.array([len(x) for x in ids]), np.array(list(chain.from_iterable(ids)), np.int32)

    def _merge(self, s: np.ndarray, w: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """The symbols of each column after its merges, its free cells at the end -1.

        ``w`` holds the ranks of adjacent pairs, -1 for none. Every column merges its best pair, or leaves: the
        others have a cell less.
        """
        out = np.full_like(s, -1)
        rows = np.arange(s.shape[1])
        while len(s) > 1:
            best, at = w[0].copy(), np.zeros(len(rows), np.int64)
            for c in range(1, len(w)):
                np.copyto(at, c, where=w[c] > best)  # the leftmost among equals
                np.maximum(best, w[c], out=best)
            on = best >= 0
            if not on.all():
                off = np.flatnonzero(~on)
                out[: len(s), rows[off]] = s[:, off]
                on = np.flatnonzero(on)
                rows, at, s, w = rows[on], at[on], s.take(on, 1), w.take(on, 1)
                if not len(rows):
                    return out
            r = np.arange(len(rows))
            new = self.joined(s[at, r], s[at + 1, r])
            for c in range(len(w)):
                right = at < c
                np.copyto(s[c], s[c + 1], where=right)
                if c + 1 < len(w):
                    np.copyto(w[c], w[c + 1], where=right)
            s, w = s[:-1], w[:-1]
            s[at, r] = new
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < len(w))
            column, place = np.concatenate([left, right]), np.concatenate([at[left] - 1, at[right]])
            b = s[place + 1, column]
            w[place, column] = np.where(b >= 0, rank[self.joined(s[place, column], np.maximum(b, 0))], -1)
        out[: len(s), rows] = s
        return out

    def _heap(self, chunk: str) -> list[int]:
        """The agenda of one long chunk as a heap over a linked list."""
        s = self.of_char[np.frombuffer(chunk.encode("utf-32-le", "surrogatepass"), np.uint32)]
        first = self.joined(s[:-1], s[1:]).tolist()
        s = s.tolist()
        n = len(s)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        score, table = self.score, self._lookup
        agenda = [(-score[m], i, s[i], s[i + 1], m) for i, m in enumerate(first) if m >= 0]
        heapq.heapify(agenda)
        alive = [True] * n
        while agenda:
            _, i, a, b, m = heapq.heappop(agenda)
            k = after[i]
            if not alive[i] or s[i] != a or k < 0 or s[k] != b:
                continue
            s[i], alive[k], after[i] = m, False, after[k]
            if after[k] >= 0:
                before[after[k]] = i
            for p, q in ((before[i], i), (i, after[i])):
                if p >= 0 and q >= 0 and (new := table(s[p], s[q])) >= 0:
                    heapq.heappush(agenda, (-score[new], p, s[p], s[q], new))
        return [x for x, on in zip(s, alive, strict=True) if on]

    def _lookup(self, a: int, b: int) -> int:
        key = (a << 32) | b
        slot = ((key * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF) >> (64 - self.bits)
        while (found := self.keys[slot]) != -1:
            if found == key:
                return int(self.values[slot])
            slot = (slot + 1) & self.mask
        return -1

    def _ids(self, chunk: str, symbols: list[int]) -> list[int]:
        """The ids of a chunk's symbols; characters unknown to every piece are read from the chunk by position."""
        out: list[int] = []
        at = 0
        for x in symbols:
            if x < 0:
                break
            if x == self.other:
                out.extend(self._bytes(chunk[at]))
                at += 1
            else:
                out.extend(self.ids[x])
                at += len(self.symbols[x])
        return out

    def _chunks(self, text: str) -> list[str]:
        """The chunks of a text and the mark in front, each without its first mark; spaces stand for marks: most are plain ASCII."""
        if "  " in text or text[0] == " " or text[-1] == " ":
            return [c[1:] for c in _RUNS(" " + text)]
        return text.split(" ")

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each whole text, as the library gives them without options; it is asked about every one."""
        kept = self.kept
        chunks = [self._chunks(t.replace(MARK, " ") if MARK in t else t) if t else [] for t in texts]
        counts = np.array([len(c) for c in chunks], np.int64)
        at = np.fromiter(map(kept.__getitem__, chain.from_iterable(chunks)), np.int64, int(counts.sum()))
        for names, n, ids in self._matrix(kept.new):
            kept.store(names, n, ids)
        long_ids = [self._ids(c, self._heap(c)) for c in (" " + c for c in kept.long)]
        n_long = np.array([len(x) for x in long_ids], np.int64)
        short = at >= 0
        n_at, start = kept.n[np.where(short, at, 0)], kept.start[np.where(short, at, 0)]
        if len(long_ids):  # ids of long chunks lie apart, the store is never copied
            n_at[~short], start[~short] = n_long[-1 - at[~short]], (np.cumsum(n_long) - n_long)[-1 - at[~short]]
        ends = np.concatenate([[0], np.cumsum(n_at)])
        places = np.repeat(start - ends[:-1], n_at) + np.arange(ends[-1])
        if len(long_ids):
            held = np.repeat(short, n_at)
            found = np.empty(len(places), np.int32)
            found[held], found[~held] = kept.flat[places[held]], np.array(list(chain.from_iterable(long_ids)), np.int32)[places[~held]]
            ids = found.tolist()
        else:
            ids = kept.flat[places].tolist()
        at = at[short]
        bounds = ends[np.concatenate([[0], np.cumsum(counts)])].tolist()
        kept.trim(at)
        out = [ids[lo:hi] for lo, hi in zip(bounds[:-1], bounds[1:], strict=True)]
        self.check(texts, out)
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids, num_threads=1)

    def check(self, texts: list[str], ids: list[list[int]]) -> None:
        """Raises unless the library gives the same ids."""
        for text, ours, theirs in zip(texts, ids, self.library.encode(texts, num_threads=1), strict=True):
            if ours != theirs:
                raise AssertionError(f"agenda and library differ on a text of {len(text)} characters: {text[:80]!r}")


class _Kept(dict):
    """Places of chunks in a flat store of ids. Asking for an unknown chunk gives it a place and lists it
    in ``new``, or for a long one a negative place of this round (-1, -2, ...), listed in ``long``."""

    def __init__(self) -> None:
        super().__init__()
        self._empty()

    def _empty(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.long: dict[str, int] = {}
        self.flat, self.used = np.zeros(1 << 16, np.int32), 0
        self.start, self.n = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def __missing__(self, chunk: str) -> int:
        if len(chunk) > SHORT:
            return self.long.setdefault(chunk, -1 - len(self.long))
        at = self[chunk] = len(self)
        self.new.append(chunk)
        return at

    def store(self, names: list[str], n: np.ndarray, ids: np.ndarray) -> None:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while len(self) > len(self.n):
            self.start, self.n = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.n))
        places = np.fromiter(map(self.__getitem__, names), np.int64, len(names))
        self.start[places], self.n[places] = self.used + np.cumsum(n) - n, n
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)

    def trim(self, used: np.ndarray) -> None:
        """Ends a round; a store beyond its bound keeps the chunks that this round used."""
        self.new, self.long = [], {}
        if len(self) > CACHE:
            on = np.zeros(len(self), bool)
            on[used[used < len(self)]] = True
            names = [c for c, x in zip(self, on.tolist(), strict=True) if x]
            n, start, flat = self.n[: len(self)][on], self.start[: len(self)][on], self.flat
            self._empty()
            if len(names) <= CACHE:
                self.update((c, i) for i, c in enumerate(names))
                self.store(names, n, flat[np.repeat(start - np.cumsum(n) + n, n) + np.arange(n.sum())])


_models: dict[str, PieceModel] = {}
worker_stores["pieces"] = _models.clear


def model(path: str) -> PieceModel:
    """One model a worker process."""
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def encode_documents(docs: DataFrame, model_file: str, keep: tuple[str, ...] = ("doc_id",), with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """``keep`` columns, n_tokens, ids_sha256, decoded_sha256 and, on demand, ids and decoded of each row of docs.

    A narrow map over Arrow batches: no shuffle, memory bounded by the batch and the store of chunks,
    in scripts without spaces too, as long chunks are not kept. A null
    text counts as empty: no ids, and the hashes of the empty string. Repeated rows stay. Columns
    other than ``keep`` and text are ignored, so clashing names cannot matter; the new columns win.
    """
    fields = [f"{docs.schema[c].simpleString().replace(':', ' ', 1)}" for c in keep]
    out = ", ".join([*fields, "n_tokens long", "ids_sha256 string", "decoded_sha256 string", *["ids array<int>"] * with_ids, *["decoded string"] * with_text])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(model_file)
        names = m.text_of_id.__getitem__
        gc.freeze()  # the lists at hand hold no cycles: collections would walk them over and over
        gc.disable()
        try:
            for batch in batches:
                texts = batch.column(len(keep)).fill_null("")
                for lo, hi in slices(texts, SLICE):
                    part = texts.slice(lo, hi - lo).to_pylist()
                    ids = m.encode(part)
                    text = m.decode(ids)
                    columns = [batch.column(i).slice(lo, hi - lo) for i in range(len(keep))]
                    columns.append(pa.array([len(x) for x in ids], pa.int64()))
                    columns.append(pa.array([hashlib.sha256(",".join(map(names, x)).encode()).hexdigest() for x in ids]))
                    columns.append(pa.array([hashlib.sha256(x.encode("utf-8")).hexdigest() for x in text]))
                    if with_ids:
                        columns.append(pa.array(ids, pa.list_(pa.int32())))
                    if with_text:
                        columns.append(pa.array(text, pa.string()))
                    yield pa.RecordBatch.from_arrays(columns, [*keep, "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids, *["decoded"] * with_text])
        finally:
            gc.enable()
            gc.unfreeze()
            give_back()

    return docs.select(*keep, "text").mapInArrow(run, out)
