"""SentencePiece models run by the tokenizers library: parsed from the protobuf, rebuilt, verified against sentencepiece."""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, of_worker

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


@dataclass
class Spec:
    """What of a ModelProto decides the encoding."""

    pieces: list[tuple[str, float, int]]
    model_type: int = UNIGRAM
    byte_fallback: bool = False
    charsmap: bytes = b""
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    escape_whitespaces: bool = True


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field, value) of a protobuf message: whole numbers, and bytes of all else."""
    at = 0

    def number() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            if b < 128:
                return out
            shift += 7

    while at < len(data):
        key = number()
        kind = key & 7
        if kind == 0:
            yield key >> 3, number()
            continue
        size = {1: 8, 5: 4}.get(kind) or (number() if kind == 2 else None)
        if size is None:
            raise ValueError(f"wire type {kind} in a model")
        yield key >> 3, data[at : at + size]
        at += size


def parse_model(data: bytes) -> Spec:
    spec = Spec([])
    for field, value in _fields(data):
        if field == 1:
            piece = dict(_fields(value))
            score = float(np.frombuffer(piece[2], "<f4")[0]) if 2 in piece else 0.0
            spec.pieces.append((piece.get(1, b"").decode(), score, piece.get(3, NORMAL)))
        elif field == 2:
            trainer = dict(_fields(value))
            spec.model_type, spec.byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
        elif field == 3:
            n = dict(_fields(value))
            spec.charsmap = n.get(2, b"")
            spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces = bool(n.get(3, 1)), bool(n.get(4, 1)), bool(n.get(5, 1))
    return spec


def _merges(spec: Spec) -> list[tuple[str, str]]:
    """Every way to put a piece together from two pieces, best scores first: the order in which sentencepiece merges."""
    ids = {p: i for i, (p, _, kind) in enumerate(spec.pieces) if kind in (NORMAL, USER_DEFINED, UNUSED)}
    found = []
    for piece, i in ids.items():
        ways = [(ids[piece[:k]], ids[piece[k:]]) for k in range(1, len(piece)) if piece[:k] in ids and piece[k:] in ids]
        found += [(-spec.pieces[i][1], i, *way) for way in ways]
    return [(spec.pieces[a][0], spec.pieces[b][0]) for _, _, a, b in sorted(found)]


class Backend:
    """A tokenizers pipeline that gives sentencepiece's ids.

    ``tok`` is the whole pipeline: normaliser, metaspace pre-tokeniser, model, decoder. Where no piece has the marker behind
    another character, no merge or path reaches over a word's end; where besides the normaliser works on single characters (no
    character map, no white space taken out), a text is cut at its spaces and each distinct word goes through the pipeline once
    while it is remembered (two tables of about ``most`` bytes take turns). All other models encode whole texts."""

    def __init__(self, data: bytes, most: int = 128 << 20):
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

        self.spec = spec = parse_model(data)
        unknown = next(i for i, p in enumerate(spec.pieces) if p[2] == UNKNOWN)

        def model() -> models.Model:
            if spec.model_type == UNIGRAM:
                return models.Unigram([(p, s) for p, s, _ in spec.pieces], unk_id=unknown, byte_fallback=spec.byte_fallback)
            if spec.model_type == BPE:
                return models.BPE({p: i for i, (p, _, _) in enumerate(spec.pieces)}, _merges(spec), unk_token=spec.pieces[unknown][0], fuse_unk=True, byte_fallback=spec.byte_fallback)
            raise ValueError(f"model type {spec.model_type}: only unigram and BPE models are encoded")

        steps = [normalizers.Precompiled(spec.charsmap)] if spec.charsmap else []
        if spec.remove_extra_whitespaces:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        mark = MARK if spec.escape_whitespaces else " "
        if spec.add_dummy_prefix:
            steps.append(normalizers.Prepend(mark))
        if spec.escape_whitespaces:
            steps.append(normalizers.Replace(" ", MARK))
        #: No piece has the marker behind another character: words can be encoded apart.
        self.apart = spec.escape_whitespaces and not any(re.search(f"[^{MARK}]{MARK}", p) for p, _, kind in spec.pieces if kind in (NORMAL, USER_DEFINED))
        self.apart &= not spec.charsmap and not spec.remove_extra_whitespaces and not any(kind == USER_DEFINED for *_, kind in spec.pieces)
        self.tok, self.core = Tokenizer(model()), Tokenizer(model())
        self.tok.normalizer = normalizers.Sequence(steps)
        if self.apart:
            self.tok.pre_tokenizer = pre_tokenizers.Split(Regex(f"{MARK}+[^{MARK}]*|[^{MARK}]+"), "isolated")
        if own := [p for p, _, kind in spec.pieces if kind == USER_DEFINED]:
            self.tok.add_tokens([AddedToken(p, normalized=True) for p in own])
        tail = [decoders.Strip(" ", left=1)] if spec.add_dummy_prefix else []
        self.tok.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *tail])
        self.core.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
        #: Words of a text whose first marker is a space: the spaces before a word belong to it.
        self.word, self.lead = re.compile(" +[^ ]*|[^ ]+"), " " if spec.add_dummy_prefix else ""
        self.core.normalizer = normalizers.Replace(" ", mark)
        self.most, self.room, self.known, self.old, self.odd = most, most, {}, {}, {}

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of whole texts."""
        return [np.frombuffer(raw, "<u4").tolist() for raw, _ in self.encode_raw(texts)]

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.tok.decode_batch(ids, skip_special_tokens=False)

    def encode_raw(self, texts: list[str]) -> list[tuple[bytes, bool]]:
        """(ids as little-endian unsigned 32-bit bytes, whether they decode to the text) of whole texts.

        A text's decoded form is that of its words, one after another, without the marker that the normaliser puts first."""
        if not self.apart:
            ids = [e.ids for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]
            return [(np.asarray(x, "<u4").tobytes(), back == t) for x, back, t in zip(ids, self.decode(ids), texts)]
        if self.room < 0:
            self.known, self.old, self.room = {}, self.known, self.most  # what is still in use comes back from the old table
            self.odd = {w: back for w, back in self.odd.items() if w in self.old}
        known, old = self.known, self.old
        cut = [self.word.findall(self.lead + t) if t else [] for t in texts]
        new = set().union(*cut).difference(known)
        self.room -= 3 * sum(map(len, new)) + 190 * len(new)
        known.update((w, old[w]) for w in new if w in old)
        self._learn([w for w in new if w not in old])
        out = []
        for text, ws in zip(texts, cut):
            same = True
            if self.odd and not self.odd.keys().isdisjoint(ws):
                same = "".join([self.odd.get(w, w) for w in ws])[len(self.lead) :] == text
            out.append((b"".join(map(known.__getitem__, ws)), same))
        return out

    def _learn(self, words: list[str]) -> None:
        """Remembers each word's ids, and what they decode to where that isn't the word itself."""
        for i in range(0, len(words), 4096):
            some = words[i : i + 4096]
            ids = [e.ids for e in self.core.encode_batch_fast(some, add_special_tokens=False)]
            self.known.update(zip(some, (array("I", x).tobytes() for x in ids)))
            whole = self.core.decode(list(chain.from_iterable(ids)), skip_special_tokens=False)
            if whole != "".join(some):  # a word that doesn't come back: which?
                back = self.core.decode_batch(ids, skip_special_tokens=False)
                self.odd.update((w, b) for w, b in zip(some, back) if b != w)


def backend(path: str):
    """(Backend, sentencepiece's own processor) of a model file, once a Python worker."""

    def load():
        import os

        import sentencepiece

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "true")
        with open(path, "rb") as f:
            data = f.read()
        return Backend(data), sentencepiece.SentencePieceProcessor(model_proto=data)

    return of_worker(("sentencepiece", path), load)


def encode_documents(docs: DataFrame, model: str, keep_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every whole text and decodes the ids again.

    Returns id_col, n_ids, ids_crc32 (unsigned, of little-endian unsigned 32-bit ids), parity (the ids are those that the
    sentencepiece library gives for the whole text), round_trip (the decoded text is the text), and with ``keep_ids`` the ids.

    Null texts have null ids, null n_ids, ids_crc32, parity and round_trip; empty texts have no ids. Null ids of rows and
    repeated rows are kept. An empty table gives no rows; other columns take no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, other = backend(model)
        for batch in blocks(batches, "text"):
            texts = batch["text"].to_pylist()
            there = [t for t in texts if t is not None]
            theirs = other.encode(there, num_threads=1) if there else []
            done = iter([(raw, raw == array("I", x).tobytes(), back) for (raw, back), x in zip(own.encode_raw(there), theirs)])
            rows = [(len(x[0]) // 4, zlib.crc32(x[0]), x[1], x[2], np.frombuffer(x[0], "<u4").tolist() if keep_ids else None) if (x := next(done) if t is not None else None) else (None,) * 5 for t in texts]
            cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.list_(pa.int32())))]
            yield pa.RecordBatch.from_arrays([batch["id"], *cols[: 4 + keep_ids]], ["id", "n_ids", "ids_crc32", "parity", "round_trip", "ids"][: 5 + keep_ids])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = f"id {rows.schema['id'].dataType.simpleString()}, n_ids long, ids_crc32 long, parity boolean, round_trip boolean" + ", ids array<int>" * keep_ids
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode_documents(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Texts of the ids: id_col, text.

    Null ids give null texts, empty ones the empty text. Rows with null id_col and repeated rows are kept; an empty table gives no
    rows. Batches are decoded a few million ids at a time, a longer row by itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, _ = backend(model)
        for batch in batches:
            sizes = pc.fill_null(pc.list_value_length(batch["ids"]), 0).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // (2 << 20))) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                part = batch.slice(a, b - a)
                ids = part["ids"].to_pylist()
                texts = iter(own.decode([x for x in ids if x is not None]))
                yield pa.RecordBatch.from_arrays([part["id"], pa.array([None if x is None else next(texts) for x in ids], pa.string())], ["id", "text"])

    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, text string").withColumnRenamed("id", id_col)
