"""Ids of whole texts with the ``tokenizers`` library, encoding each distinct piece of text once.

A text is cut where no pre-token of the vocabulary can cross, each distinct piece is encoded by the
library, and the ids are put together again. Two kinds of vocabulary are known:

* dropped space (``spaced=False``): the normaliser drops white space, so a piece is a run without it;
* attached space (``spaced=True``): one space belongs to the next word, so a piece begins at its space,
  and a line break is a piece of its own.

Letters and signs never share a pre-token, so a text is also cut before a full stop or comma, if every
one of them stands behind a plain letter or digit. A text with white space beyond ASCII or in runs is
encoded whole. Cutting and the search for distinct pieces are Arrow's, so Python sees each distinct piece
of a batch once.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from rollweave.llm import kernel

#: Pieces remembered by one worker (about 200 bytes each); at the bound the memory starts anew.
REMEMBERED = 1_000_000

CUT = "\x01"
#: White space, or lead bytes of it, beyond the ASCII set.
_ODD = re.compile("[\x01\x1c-\x1f\x85\xa0  -​    　﻿]")
_LEADS = np.isin(np.arange(256), [1, 0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3, 0xEF])
_SIGNS = np.isin(np.arange(256), [44, 46])
_ALNUM = np.isin(np.arange(256), np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", dtype=np.uint8))
#: Last bytes of two-byte letters behind the lead byte 0xC3.
_ACCENTED = np.isin(np.arange(256), [x for x in range(0x80, 0xC0) if x not in (0x97, 0xB7)])
#: Words of letters that every rule takes for letters.
_WORD = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")


def _byte_signs() -> list[str]:
    """The printable sign that byte-level vocabularies write for each byte."""
    own = [b for b in range(256) if chr(b).isprintable() and b != 32 and b != 0xAD]
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


_BYTE_SIGNS = _byte_signs()


def _rows(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Which rows hold a flagged byte."""
    out = np.zeros(len(offsets) - 1, dtype=bool)
    at = np.flatnonzero(flags)
    out[np.searchsorted(offsets, at, side="right") - 1] = True
    return out


class Encoder:
    """``ids(texts)`` gives an array of unsigned 32 bit ids of each text; a null text has none."""

    def __init__(self, path: str, spaced: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.spaced = spaced
        self.known: dict[str, bytes] = {}
        # The same merges for words of letters alone, which no normaliser or cut rule changes.
        bare = json.loads(self.tokenizer.to_str())
        bare.update(normalizer=None, pre_tokenizer={"type": "WhitespaceSplit"}, post_processor=None, decoder=None, added_tokens=[])
        self.merges = Tokenizer.from_str(json.dumps(bare))
        self.letters = {i: "".join(_BYTE_SIGNS[b] for b in chr(i).encode()) for i in range(128, 256)}
        #: Ids that open a piece (attached space), or close one (dropped space).
        self.edge = np.zeros(self.tokenizer.get_vocab_size(), dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.edge[i] = token.startswith("Ġ") if spaced else token.endswith("</w>")

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype=np.uint32).tobytes() for x in found]

    def _joined(self, pieces: list[str]) -> list[bytes]:
        """Words of plain letters, many to a call; the ids of their edges part them."""
        text = "".join(pieces).replace(" ", " Ġ") if self.spaced else " ".join(pieces).lower()
        found = self.merges.encode_batch_fast([text.translate(self.letters)], add_special_tokens=False)[0]
        ids = np.array(found.ids, dtype=np.uint32)
        at = np.flatnonzero(self.edge[ids])
        bounds = (np.append(at, len(ids)) if self.spaced else np.append(0, at + 1)) * 4
        if len(bounds) != len(pieces) + 1:
            return self._whole(pieces)
        raw, bounds = ids.tobytes(), bounds.tolist()
        return [raw[a:b] for a, b in zip(bounds, bounds[1:])]

    def _learn(self, new: list[str]) -> None:
        fits, first = _WORD.fullmatch, 1 if self.spaced else 0
        plain = [p for p in new if fits(p, first) and (not first or p[0] == " ")]
        for start in range(0, len(plain), 500):
            part = plain[start : start + 500]
            self.known.update(zip(part, self._joined(part)))
        if len(plain) < len(new):
            rest = list(set(new).difference(plain))
            self.known.update(zip(rest, self._whole(rest)))

    def _judge(self, texts: kernel.Texts) -> tuple[np.ndarray, np.ndarray]:
        """Of each row: whether it may be cut, and whether its full stops and commas may be cut off."""
        data, offsets = texts.data, texts.offsets
        before = np.empty_like(data)
        before[:1], before[1:] = 32, data[:-1]
        before[offsets[:-1][offsets[:-1] < len(data)]] = 32
        lead = np.empty_like(data)
        lead[:2], lead[2:] = 0, data[:-2]
        letter = _ALNUM[before] | ((lead == 0xC3) & _ACCENTED[before])
        space = kernel.SPACE[data]
        odd = _rows(_LEADS[data], offsets)
        for i in np.flatnonzero(odd):
            odd[i] = _ODD.search(texts.bytes_of(offsets[i], offsets[i + 1]).decode()) is not None
        if self.spaced:
            # White space at the start of a text, next to other white space, or at the end.
            odd |= _rows(space & kernel.SPACE[before], offsets)
            full = offsets[1:] > offsets[:-1]
            odd[full] |= space[offsets[1:][full] - 1]
        else:
            letter |= kernel.SPACE[before]
        return ~odd & (offsets[1:] > offsets[:-1]), ~_rows(_SIGNS[data] & ~letter, offsets)

    def _pieces(self, column: pa.Array, signs: bool) -> pa.Array:
        mark = CUT if self.spaced else " "
        if signs:
            for sign in ".,":
                column = pc.replace_substring(column, sign, mark + sign)
        if not self.spaced:
            return pc.ascii_split_whitespace(column)
        column = pc.replace_substring(pc.replace_substring(column, " ", CUT + " "), "\n", CUT + "\n" + CUT)
        return pc.split_pattern(column, CUT)

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        out: list[np.ndarray] = [np.zeros(0, dtype=np.uint32)] * len(texts)
        if len(self.known) > REMEMBERED:
            self.known = {}
        for part in kernel.blocks(texts, 1 << 22):
            cut, signs = self._judge(part)
            own = texts.slice(part.first, len(part))
            whole = np.flatnonzero(~cut & (part.offsets[1:] > part.offsets[:-1]))
            for i, raw in zip(whole, self._whole(own.take(pa.array(whole)).to_pylist()) if len(whole) else ()):
                out[part.first + i] = np.frombuffer(raw, dtype=np.uint32)
            for rows, at in ((np.flatnonzero(cut & signs), True), (np.flatnonzero(cut & ~signs), False)):
                if len(rows):
                    found = self._put_together(self._pieces(own.take(pa.array(rows)), at))
                    for i, ids in zip(rows, found):
                        out[part.first + i] = ids
        return out

    def _put_together(self, lists: pa.Array) -> list[np.ndarray]:
        coded = lists.flatten().dictionary_encode()
        pieces, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        known = self.known
        known[""] = b""
        values = list(map(known.get, pieces))
        new = [p for p, v in zip(pieces, values) if v is None]
        if new:
            self._learn(new)
            values = list(map(known.__getitem__, pieces))
        size = np.fromiter(map(len, values), np.int64, len(values)) // 4
        flat = np.frombuffer(b"".join(values), dtype=np.uint32)
        length = size[index]
        end = np.cumsum(length)
        ids = flat[np.repeat((np.cumsum(size) - size)[index] - end + length, length) + np.arange(int(end[-1]))]
        edges = np.append(0, end)[bounds]
        return [ids[a:b] for a, b in zip(edges, edges[1:])]


_encoders: dict[tuple[str, bool], Encoder] = {}
kernel.FORGET.append(_encoders.clear)


def encoder(path: str, spaced: bool) -> Encoder:
    """One encoder for each worker process and vocabulary."""
    key = (path, spaced)
    if key not in _encoders:
        _encoders[key] = Encoder(path, spaced)
    return _encoders[key]
