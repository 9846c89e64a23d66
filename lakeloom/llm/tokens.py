"""Batch encoding with the tokenizers library.

A corpus repeats its words, so a batch is cut into pieces at places where the
tokenizer always starts a new pre-token, and each distinct piece is encoded
once. The ids are those of encoding every whole text.
"""

from __future__ import annotations

import functools
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lakeloom.llm.common import string_bytes

#: Pieces one Python worker remembers (about 45 bytes each).
CACHE_PIECES = 1_000_000
_JOIN = 2_000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_PUNCT = np.zeros(256, dtype=bool)
_PUNCT[[c for c in range(0x21, 0x7F) if not chr(c).isalnum()]] = True
_APOSTROPHE = 0x27


def _closed(data: np.ndarray) -> np.ndarray:
    """For each byte but the first: is the character before it surely neither
    white space nor part of a longer sequence? (ASCII, or a two-byte
    character other than U+0080..U+00BF; others count as unsure.)"""
    prev = data[:-1]
    ok = (prev > 0x20) & (prev < 0x7F)
    lead = np.zeros(len(prev), dtype=bool)
    lead[1:] = (data[:-2] >= 0xC3) & (data[:-2] <= 0xDF)
    return ok | (lead & (prev >= 0x80))


class Encoder:
    """Ids of texts by one tokenizer file of the tokenizers library.

    ``add_special_tokens`` is off, and the strings of special tokens inside a
    text are ordinary text. Byte-level files whose pre-tokens keep a leading
    space and word files that drop white space (``lower`` case) are cut into
    pieces; any other file is encoded text by text.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        self.kind = self._kind()
        vocab = self.tok.get_vocab(with_added_tokens=True)
        self.vocab_size = max(vocab.values()) + 1
        if self.kind == "bytes":
            self.width = np.zeros(self.vocab_size, dtype=np.int64)
            for s, i in vocab.items():
                self.width[i] = len(s)          # byte-level: one character a byte
            self.sep = " \x01a"
            self.n_sep = len(self._ids([self.sep])[0])
        elif self.kind == "words":
            self.sep_id = self._ids(["\x01"])[0]
            if len(self.sep_id) != 1:
                self.kind = "whole"
        self._forget()

    def _kind(self) -> str:
        norm, pre = str(self.tok.normalizer), str(self.tok.pre_tokenizer)
        if self.tok.normalizer is None and pre.startswith("ByteLevel(add_prefix_space=False") \
                and "use_regex=True" in pre:
            return "bytes"
        if "Lowercase" in norm and "Removed" in pre and "[^\\s\\p{L}\\p{N}]+" in pre:
            return "words"
        return "whole"

    def _ids(self, texts: list[str]) -> list[np.ndarray]:
        run = getattr(self.tok, "encode_batch_fast", self.tok.encode_batch)
        return [np.array(e.ids, dtype=np.uint32) for e in run(texts, add_special_tokens=False)]

    def _forget(self) -> None:
        self.known = pa.array([], pa.large_binary())
        self.at = np.zeros(1, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    # --- pieces --------------------------------------------------------------
    def _cuts(self, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte ranges of the pieces, and the index of each row's first piece."""
        begin = np.zeros(len(data) + 1, dtype=bool)
        cur, prev = data[1:], data[:-1]
        if len(data) > 1:
            begin[1:-1] = _LETTER[prev] & _PUNCT[cur]
            space = _SPACE[cur]
            if self.kind == "bytes":
                begin[1:-1] |= space & _closed(data)
            else:
                begin[1:-1] |= space != _SPACE[prev]
                begin[1:-1] |= _PUNCT[prev] & (prev != _APOSTROPHE) & _LETTER[cur]
        begin[offs] = True
        start = np.flatnonzero(begin[:-1])
        end = np.append(start[1:], len(data))
        if self.kind == "words":
            keep = ~_SPACE[data[start]] if len(start) else np.zeros(0, dtype=bool)
            start, end = start[keep], end[keep]
        return start, end, np.searchsorted(start, offs, side="left")

    def _encode_pieces(self, pieces: list[bytes]) -> list[np.ndarray]:
        texts = [p.decode("utf-8") for p in pieces]
        out: list[np.ndarray | None] = [None] * len(texts)
        if self.kind == "bytes":
            odd = [i for i, p in enumerate(pieces)
                   if not (_SPACE[p[0]] or (_PUNCT[p[0]] and p[0] != _APOSTROPHE))
                   or p[-1] >= 0x80 and texts[i][-1].isspace() or _SPACE[p[-1]]]
        else:
            odd = [i for i, p in enumerate(pieces) if b"\x01" in p or not texts[i].strip()]
        alone = set(odd)
        rest = [i for i in range(len(texts)) if i not in alone]
        groups = [rest[i:i + _JOIN] for i in range(0, len(rest), _JOIN)]
        if self.kind == "bytes":
            joined = ["".join([self.sep + texts[i] for i in g]) for g in groups]
        else:
            joined = ["".join([texts[i] + " \x01 " for i in g]) for g in groups]
        for g, ids in zip(groups, self._ids(joined)):
            if self.kind == "bytes":
                ends = np.cumsum(np.array([len(self.sep) + len(pieces[i]) for i in g]))
                place = np.cumsum(self.width[ids])
                last = np.searchsorted(place, ends)
                ok = len(place) == last[-1] + 1 and bool((place[last] == ends).all())
                cut = np.concatenate([[0], last + 1])
                lead, tail = self.n_sep, 0
            else:
                last = np.flatnonzero(ids == self.sep_id[0])
                ok = len(last) == len(g)
                cut = np.concatenate([[0], last + 1])
                lead, tail = 0, 1
            if not ok:
                odd.extend(g)
                continue
            for q, i in enumerate(g):
                out[i] = ids[cut[q] + lead:cut[q + 1] - tail]
        for i, ids in zip(odd, self._ids([texts[i] for i in odd])):
            out[i] = ids
        return out

    # --- texts ---------------------------------------------------------------
    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Flat uint32 ids of all rows and the int64 offsets of the rows
        (null: no ids)."""
        if self.kind == "whole":
            got = self._ids([t or "" for t in texts.to_pylist()])
            offs = np.concatenate([[0], np.cumsum([len(g) for g in got])]).astype(np.int64)
            return np.concatenate([*got, np.zeros(0, np.uint32)]).astype(np.uint32), offs
        data, offs = string_bytes(texts)
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        if self.kind == "words":
            data = np.where((data >= 0x41) & (data <= 0x5A), data + np.uint8(32), data)
        start, end, first = self._cuts(data, offs)
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(offs), np.int64)
        if self.kind == "bytes":             # the pieces cover the text
            bounds, body = np.append(start, len(data)).astype(np.int64), data
        else:                                # white space between them is left out
            body = data[~_SPACE[data]]
            bounds = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
        flat = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(start), [None, pa.py_buffer(bounds),
                                            pa.py_buffer(np.ascontiguousarray(body))])
        enc = flat.dictionary_encode()
        codes = enc.indices.to_numpy(zero_copy_only=False)
        at, ids = self._lookup(enc.dictionary)
        size = (at[1:] - at[:-1])[codes]
        total = np.concatenate([[0], np.cumsum(size)])
        where = np.repeat(at[:-1][codes] - total[:-1], size) + np.arange(total[-1])
        return ids[where], total[first]

    def _lookup(self, uniq: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and flat ids of the distinct pieces."""
        if len(self.known):
            pos = pc.index_in(uniq, self.known)
        else:
            pos = pa.nulls(len(uniq), pa.int32())
        missing = np.asarray(pos.is_null())
        fresh = uniq.filter(pa.array(missing))
        got = self._encode_pieces(fresh.to_pylist()) if len(fresh) else []
        size = np.array([len(g) for g in got], dtype=np.int64)
        base = len(self.ids)
        all_ids = np.concatenate([self.ids, *got]).astype(np.uint32)
        all_at = np.concatenate([self.at, base + np.cumsum(size)]).astype(np.int64)
        index = np.asarray(pos.fill_null(0)).astype(np.int64)
        index[missing] = len(self.known) + np.arange(len(got))
        length = (all_at[1:] - all_at[:-1])[index]
        at = np.concatenate([[0], np.cumsum(length)])
        where = np.repeat(all_at[:-1][index] - at[:-1], length) + np.arange(at[-1])
        if len(self.known) + len(fresh) <= CACHE_PIECES:
            self.known = pa.concat_arrays([self.known, fresh])
            self.at, self.ids = all_at, all_ids
        return at, all_ids[where]


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """The worker's encoder of a tokenizer file."""
    return Encoder(path)


def known_path(name: str) -> str:
    """Place of a public tokenizer file on this machine."""
    import public_tokenizers
    return public_tokenizers.path(name)
