"""Byte-level BPE ids of whole texts by the tokenizers library, with a bounded memory of chunks already encoded."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import of_worker

#: A run of spaces and the run of other characters after it. Where a space follows a character that is not white space, the
#: tokenizer's own pattern always starts a new word, so chunks can be encoded apart.
CHUNK = re.compile(r" *[^ ]+| +")
#: White space other than a space, then a space that the pattern could join with it: such texts are encoded as one.
MIXED = re.compile(r"[^\S ](?: \s| *$)|[\x1c-\x1f\x85](?: |$)")

#: In texts without these, and without other white space at their end, each space starts a chunk and ``MIXED`` finds nothing.
ODD = r" [\s\x0b\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[\x1c-\x1f\x{85}]"


class ChunkEncoder:
    """ids of a text as little-endian unsigned 32-bit bytes. Memory is bounded: two tables of chunks of about ``most`` bytes take turns."""

    def __init__(self, path: str, most: int = 140 << 20):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True  # their strings in a text are ordinary text
        self.most, self.room, self.known, self.old = most, most, {}, {}
        vocabulary = self.tok.get_vocab(with_added_tokens=True)
        self.width = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes of each id: its string has a character for each
        self.width[list(vocabulary.values())] = [len(x) for x in vocabulary]

    def _raw(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, chunks: list[str], at_once: int = 2000) -> None:
        """Encodes chunks that start with a space and end otherwise as one text: one call is cheaper than a call each."""
        for i in range(0, len(chunks), at_once):
            some = chunks[i : i + at_once]
            raw = self._raw(["".join(some)])[0]
            ends = np.cumsum([len(c.encode()) for c in some])
            cuts = np.searchsorted(np.cumsum(self.width[np.frombuffer(raw, "<u4")]), ends) + 1
            start = 0
            for c, end in zip(some, (cuts * 4).tolist()):
                self.known[c] = raw[start:end]
                start = end

    def _known(self, chunks: list[str]) -> list[bytes]:
        """ids of chunks, of which each is asked for once."""
        known, old = self.known, self.old
        new = [c for c in chunks if c not in known and len(c) <= 200]
        self.room -= sum(map(len, new)) * 3 + 190 * len(new)  # a string, its ids and a place in the table
        known.update((c, old[c]) for c in new if c in old)
        new = [c for c in new if c not in old]
        self._learn([c for c in new if c[0] == " " and not c[-1].isspace()])
        apart = [c for c in new if c not in known]
        known.update(zip(apart, self._raw(apart)))
        try:
            return list(map(known.__getitem__, chunks))
        except KeyError:
            return [known[c] if c in known else self._raw([c])[0] for c in chunks]

    def _plain(self, texts: pa.Array) -> list[bytes]:
        """ids of texts in which each space starts a chunk: Arrow cuts and counts the words, so only different ones become Python strings."""
        words = pc.split_pattern(texts, " ")
        starts = words.offsets.to_numpy()
        coded = words.values.dictionary_encode()
        firsts, at = np.unique(coded.indices.to_numpy()[starts[:-1]], return_inverse=True)  # the first of a text has no space before it
        named = coded.dictionary.to_pylist()
        found = self._known([*(" " + w for w in named), *(w for i in firsts.tolist() if (w := named[i]))])
        if len(found) < len(named) + len(firsts):  # no word before the first space
            found.insert(len(named) + next(k for k, i in enumerate(firsts.tolist()) if not named[i]), b"")
        places = coded.indices.to_numpy().copy()
        places[starts[:-1]] = len(named) + at
        ids = pa.array(found, pa.large_binary()).take(pa.array(places))
        ends, data = np.frombuffer(ids.buffers()[1], np.int64), ids.buffers()[2]
        raw = memoryview(data) if data else b""
        cuts = ends[starts].tolist()
        return [bytes(raw[a:b]) for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        if self.room < 0:
            self.known, self.old, self.room = {}, self.known, self.most  # what is still in use comes back from the old table
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, ODD).to_numpy(zero_copy_only=False)
        tails = pc.utf8_slice_codeunits(texts, -2).to_pylist()
        odd |= np.fromiter((t.rstrip(" ")[-1:].isspace() for t in tails), bool, len(tails))
        out: list[bytes] = [b""] * len(texts)
        if not odd.all():
            plain = np.flatnonzero(~odd)
            for i, raw in zip(plain.tolist(), self._plain(texts.take(pa.array(plain)))):
                out[i] = raw
        for i in np.flatnonzero(odd).tolist():
            if MIXED.search(text := texts[i].as_py()):
                out[i] = self._raw([text])[0]
            else:
                chunks = CHUNK.findall(text)
                ids = dict(zip(different := list(dict.fromkeys(chunks)), self._known(different)))
                out[i] = b"".join(map(ids.__getitem__, chunks))
        return out


def encoder(path: str) -> ChunkEncoder:
    """One encoder for each vocabulary file and Python worker."""
    return of_worker(("bpe", path), lambda: ChunkEncoder(path))
