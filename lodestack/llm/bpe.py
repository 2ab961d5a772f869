"""Token ids of whole texts by the tokenizers library, with each distinct piece encoded once per worker.

A byte-level pre-tokenizer attaches one space to what follows it, and looks past a run of white
space only to decide whether its last character belongs to it. So a text may be cut before a
space that follows a character other than white space without changing its tokens, but not
inside a run of white space of whatever kinds; also around a line end between other characters,
and between a letter and a full stop or comma. These pieces repeat; their ids are kept in the
worker, and the library encodes the others, as the lines of one text. Texts with a special
token's string or a NUL are encoded whole by the library.
"""

from __future__ import annotations

import gc
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are cut into pieces at a time.
SLICE_BYTES = 4 << 20
#: What a piece that is kept takes besides its characters and ids: its string, its place in the table.
PIECE_BYTES = 180
#: What the pieces of a worker without a task may take.
IDLE_BYTES = 80 << 20
_WORKER: dict[tuple, PieceEncoder] = {}


def text_slices(texts: pa.Array, size: int = SLICE_BYTES):
    """(first row, array without nulls) for runs of rows with about ``size`` bytes of text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    ends = np.cumsum(np.asarray(pc.binary_length(texts), dtype=np.int64))
    at = 0
    while at < len(texts):
        before = ends[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield at, texts.slice(at, to - at)
        at = to


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: All that any pre-tokenizer may take for white space; taking more for it only means fewer cuts.
_SPACE = r"\s\x{0b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"
_RUN = f"[{_SPACE}] "
_BEFORE_SPACE = f"([^{_SPACE}]) "
_LINE_END = f"([^{_SPACE}])\n([^{_SPACE}])"
_STOP = r"([0-9A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}])([.,])"
_CUT = "\x00"
_ODD_SPACE = re.compile(r"[^\S ]")
_WHITE = re.compile(r"\s")


class Pieces:
    """A slice of texts cut into pieces.

    ``codes`` gives each piece's place among ``distinct``, ``ends`` the pieces up to each
    text's end. Texts that must not be cut are in ``whole`` by row, and empty here.
    """

    def __init__(self, texts: pa.Array, specials: list[str]):
        odd = pc.match_substring(texts, _CUT)
        for special in specials:
            odd = pc.or_(odd, pc.match_substring(texts, special))
        self.whole: dict[int, str] = {}
        if pc.any(odd).as_py():
            rows = np.flatnonzero(np.asarray(odd))
            self.whole = dict(zip(rows.tolist(), texts.take(pa.array(rows)).to_pylist(), strict=True))
            texts = pc.if_else(odd, pa.scalar("", pa.large_string()), texts)
        texts = pc.replace_substring_regex(texts, _STOP, rf"\1{_CUT}\2")
        texts = pc.replace_substring_regex(texts, _LINE_END, f"\\1{_CUT}\n{_CUT}\\2")
        runs = pc.match_substring_regex(texts, _RUN)
        spaced = pc.replace_substring(texts, " ", _CUT + " ")
        if pc.any(runs).as_py():
            careful = pc.replace_substring_regex(texts.filter(runs), _BEFORE_SPACE, f"\\1{_CUT} ")
            spaced = pc.replace_with_mask(spaced, runs, careful)
        cut = pc.split_pattern(spaced, _CUT)
        offsets = np.asarray(cut.offsets, dtype=np.int64)
        self.ends = offsets[1:] - offsets[0]
        found = cut.flatten().dictionary_encode()
        self.codes = np.asarray(found.indices)
        self.distinct = found.dictionary.to_pylist()


class PieceEncoder:
    """Encodes texts with the tokenizer at ``path``; pieces of at most about ``keep`` bytes stay in memory."""

    def __init__(self, path: str, keep: int = 96 << 20):
        self.library, self.keep = load_tokenizer(path), keep
        self.specials = [x.content for x in self.library.get_added_tokens_decoder().values()]
        self.spaced = np.zeros(self.library.get_vocab_size(), bool)
        for token, i in self.library.get_vocab().items():
            self.spaced[i] = token.startswith("Ġ")
        self._clear()

    @staticmethod
    def of_worker(path: str) -> PieceEncoder:
        """The encoder that this worker process already has, or a new one."""
        if path not in _WORKER:
            _WORKER[path] = PieceEncoder(path)
        return _WORKER[path]

    def release(self) -> None:
        """At a task's end: an idle worker keeps the library, and pieces for its next task unless they are many."""
        if self.held > IDLE_BYTES:
            self._clear()
        gc.collect()
        pa.default_memory_pool().release_unused()

    def _clear(self) -> None:
        self.table: dict[str, int] = {}
        self.flat = np.zeros(1 << 20, np.int32)
        self.starts, self.lengths = np.zeros(1 << 18, np.int64), np.zeros(1 << 18, np.int32)
        self.slots = self.used = self.held = 0
        self._learn_apart(["", " ", "\n"])
        self.newline = self.flat[self.starts[2] : self.used].copy()

    def _put(self, pieces: list[str], ids: np.ndarray, lengths: np.ndarray) -> None:
        n, k = len(ids), len(pieces)
        while self.used + n > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        while self.slots + k > len(self.starts):
            self.starts, self.lengths = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.lengths))
        self.flat[self.used : self.used + n] = ids
        self.starts[self.slots : self.slots + k] = self.used + np.cumsum(lengths) - lengths
        self.lengths[self.slots : self.slots + k] = lengths
        self.table.update(zip(pieces, range(self.slots, self.slots + k), strict=True))
        self.used += n
        self.slots += k
        self.held += 4 * n + PIECE_BYTES * k + sum(map(len, pieces))

    def _learn_apart(self, pieces: list[str]) -> None:
        found = [e.ids for e in self.library.encode_batch_fast(pieces, add_special_tokens=False)]
        self._put(pieces, np.asarray([i for x in found for i in x], np.int32), np.asarray([len(x) for x in found], np.int64))

    def _learn(self, pieces: list[str]) -> None:
        """Ids of new pieces. Those that begin with their only space are encoded as one text, whose
        tokens with a space begin pieces; those without white space as the lines of one text."""
        worded = [x for x in pieces if len(x) > 1 and x[0] == " "]
        run = "".join(worded)
        if run.count(" ") != len(worded) or _ODD_SPACE.search(run):
            worded = [x for x in worded if x.count(" ") == 1 and not _ODD_SPACE.search(x)]
            run = "".join(worded)
        lines, apart = [], []
        if len(worded) < len(pieces):
            done = set(worded)
            for x in pieces:
                if x not in done:
                    (lines if x and not _WHITE.search(x) else apart).append(x)
        if worded:
            ids = np.asarray(self.library.encode_batch_fast([run], add_special_tokens=False)[0].ids, np.int32)
            at = np.flatnonzero(self.spaced[ids])
            if len(at) == len(worded):
                self._put(worded, ids, np.diff(np.append(at, len(ids))))
            else:
                apart += worded
        if lines and len(self.newline) == 1:
            ids = np.asarray(self.library.encode_batch_fast(["\n".join(lines)], add_special_tokens=False)[0].ids, np.int32)
            at = np.concatenate([[-1], np.flatnonzero(ids == self.newline[0]), [len(ids)]])
            if len(at) == len(lines) + 1:
                self._put(lines, ids[ids != self.newline[0]], np.diff(at) - 1)
                lines = []
        if lines or apart:
            self._learn_apart(lines + apart)

    def slots_of(self, pieces: list[str]) -> np.ndarray:
        got = list(map(self.table.get, pieces))
        if None in got:
            new = [x for x, slot in zip(pieces, got, strict=True) if slot is None]
            for i in range(0, len(new), 20_000):
                self._learn(new[i : i + 20_000])
            got = list(map(self.table.__getitem__, pieces))
        return np.asarray(got, np.int64)

    def encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, and where each text's ids end."""
        if self.held > self.keep:
            self._clear()
        p = Pieces(texts, self.specials)
        slots = self.slots_of(p.distinct)[p.codes]
        n = self.lengths[slots].astype(np.int64)
        ends = np.cumsum(n)
        ids = self.flat[np.repeat(self.starts[slots] - (ends - n), n) + np.arange(int(n.sum()))]
        ends = np.concatenate([[0], ends])[p.ends]
        if p.whole:
            parts = np.split(ids, ends[:-1])
            for row, text in p.whole.items():
                parts[row] = np.asarray(self.library.encode(text, add_special_tokens=False).ids, np.int32)
            ids, ends = np.concatenate(parts), np.cumsum([len(x) for x in parts])
        return ids, ends

    def count_slice(self, texts: pa.Array, frequent: dict[str, int]) -> np.ndarray:
        """Tokens of each text: pieces in ``frequent`` by that table, others by this worker's pieces."""
        if self.held > self.keep:
            self._clear()
        p = Pieces(texts, self.specials)
        n = np.asarray([frequent.get(x, -1) for x in p.distinct], np.int64)
        miss = np.flatnonzero(n < 0)
        slots = self.slots_of([p.distinct[i] for i in miss])  # may replace self.lengths
        n[miss] = self.lengths[slots]
        out = np.diff(np.concatenate([[0], np.cumsum(n[p.codes])])[np.concatenate([[0], p.ends])])
        for row, text in p.whole.items():
            out[row] = len(self.library.encode(text, add_special_tokens=False).ids)
        return out
