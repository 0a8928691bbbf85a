"""SentencePiece models run by the tokenizers library.

The model file is read field by field (it is a protocol buffer), and its parts
are rebuilt: the normaliser (compiled character map, extra white space, dummy
prefix), the marker for spaces, and the unigram scores or the pair merges that
give the same pieces, with bytes as a fallback for characters without a piece.
Texts are encoded in batches by several threads; by merges, all but long ones are
encoded without a cut into words, which costs more than it saves there. Ids and decoded texts can be
held against the SentencePiece library itself.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cabgrid.llm import text as tx
from cabgrid.llm.scratch import small_batches

# Fixed values of the file format.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2
SPACE = "▁"
SLICE_BYTES = 512 << 10
THREADS = 2
#: Characters of a text up to which its pieces are merged without a cut into words.
WHOLE_CHARS = 1 << 15
#: One text of so many, by its hash, is encoded by the SentencePiece library too (1: every text).
PARITY_EVERY = 1


def _varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte = data[at]
        at += 1
        value |= (byte & 127) << shift
        if byte < 128:
            return value, at
        shift += 7


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol buffer message, in order."""
    at = 0
    while at < len(data):
        key, at = _varint(data, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(data, at)
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            value, at = data[at : at + size], at + size
        elif kind == 2:
            size, at = _varint(data, at)
            value, at = data[at : at + size], at + size
        else:
            raise ValueError(f"wire type {kind} isn't part of a model file")
        yield key >> 3, value


@dataclass(frozen=True)
class SpmModel:
    """What a model file says: (piece, score, kind) of every id, and settings."""

    pieces: list[tuple[str, float, int]]
    model_type: int
    byte_fallback: bool
    unk_id: int
    char_map: bytes
    dummy_prefix: bool
    squeeze_spaces: bool
    escape_spaces: bool

    @classmethod
    def parse(cls, data: bytes) -> SpmModel:
        pieces, trainer, normalizer = [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                f = dict(_fields(value))
                pieces.append((f[1].decode(), struct.unpack("<f", f[2])[0] if 2 in f else 0.0, f.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normalizer = dict(_fields(value))
        unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), trainer.get(40, 0))
        return cls(
            pieces,
            trainer.get(3, UNIGRAM),
            bool(trainer.get(35, 0)),
            unknown,
            normalizer.get(2, b""),
            bool(normalizer.get(3, 1)),
            bool(normalizer.get(4, 1)),
            bool(normalizer.get(5, 1)),
        )

    def merges(self) -> list[tuple[str, str]]:
        """Pairs in the order of their piece's score. Pieces of equal score are
        merged from the left: a pair with a longer left part goes first."""
        known = {p: i for i, (p, _, kind) in enumerate(self.pieces) if kind in (NORMAL, USER_DEFINED)}
        found = []
        for piece, i in known.items():
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if left in known and right in known:
                    score = self.pieces[i][1]
                    found.append((-score, -len(left), len(right), known[left], known[right], left, right))
        found.sort()
        return [(m[-2], m[-1]) for m in found]

    def piece_bytes(self) -> list[bytes]:
        """What each piece stands for in a decoded text."""
        return [bytes([int(p[3:5], 16)]) if kind == BYTE else p.replace(SPACE, " ").encode() for p, _, kind in self.pieces]

    @property
    def marker(self) -> str:
        return SPACE if self.escape_spaces else " "

    @property
    def marks_only(self) -> bool:
        """Whether normalising changes nothing but the prefix and the spaces."""
        return not self.char_map and not self.squeeze_spaces

    def marked(self, text: str) -> str:
        """The normalised text, if :attr:`marks_only` holds."""
        return (self.marker if self.dummy_prefix and text else "") + text.replace(" ", self.marker)

    def tokenizer(self):
        """The rebuilt tokenizer; special pieces are never matched in texts."""
        from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

        unknown = self.pieces[self.unk_id][0]
        if self.model_type == UNIGRAM:
            vocab = [(p, s) if k != UNUSED else (p, -1e9) for p, s, k in self.pieces]
            tok = Tokenizer(models.Unigram(vocab, self.unk_id, self.byte_fallback))
        elif self.model_type == BPE:
            vocab = {p: i for i, (p, _, _) in enumerate(self.pieces)}
            tok = Tokenizer(models.BPE(vocab, self.merges(), unk_token=unknown, fuse_unk=True, byte_fallback=self.byte_fallback))
        else:
            raise ValueError(f"model type {self.model_type} isn't supported")
        steps = []
        if self.char_map:
            steps.append(normalizers.Precompiled(self.char_map))
        if self.squeeze_spaces:
            steps += [normalizers.Strip(left=True, right=True), normalizers.Replace(Regex(" {2,}"), " ")]
        marker = self.marker
        if self.dummy_prefix:
            steps.append(normalizers.Prepend(marker))
        if self.escape_spaces:
            steps.append(normalizers.Replace(" ", SPACE))
        if steps:
            tok.normalizer = normalizers.Sequence(steps)
        # No piece goes on after a space that follows a letter: texts fall into
        # words, each with its spaces before it.
        if not any(marker in p.lstrip(marker) for p, _, k in self.pieces if k in (NORMAL, USER_DEFINED)):
            tok.pre_tokenizer = pre_tokenizers.Split(Regex(f"{marker}+[^{marker}]*|[^{marker}]+"), "isolated")
        after = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
        if self.dummy_prefix:
            after.append(decoders.Strip(" ", 1, 0))
        tok.decoder = decoders.Sequence(after)
        return tok


@lru_cache(maxsize=2)
def _loaded(data: bytes) -> tuple[SpmModel, object, object | None]:
    """The model, its tokenizer, and one for texts that are marked already (the same
    merges; none for other models, or if normalising does more)."""
    from tokenizers import Tokenizer

    model = SpmModel.parse(data)
    tok = model.tokenizer()
    return model, tok, Tokenizer(tok.model) if model.model_type == BPE and model.marks_only else None


def _threads(n: int) -> None:
    """For the encoder's thread pool, which starts with the first batch."""
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if n > 1 else "false"
    os.environ["RAYON_NUM_THREADS"] = str(n)


def encode_batch(data: bytes, texts: list[str], threads: int = THREADS) -> list[list[int]]:
    _threads(threads)
    model, by_words, whole = _loaded(data)
    if whole is None:
        return [e.ids for e in by_words.encode_batch_fast(texts, add_special_tokens=False)]
    marked = [model.marked(t) for t in texts if len(t) <= WHOLE_CHARS]
    short = iter(whole.encode_batch_fast(marked, add_special_tokens=False))
    long = iter(by_words.encode_batch_fast([t for t in texts if len(t) > WHOLE_CHARS], add_special_tokens=False))
    return [next(short if len(t) <= WHOLE_CHARS else long).ids for t in texts]


def decode_batch(data: bytes, ids: list[list[int]], threads: int = THREADS) -> list[str]:
    _threads(threads)
    return _loaded(data)[1].decode_batch(ids, skip_special_tokens=False)


def read_model(path: str) -> bytes:
    """A model file; a vocabulary of bounded size, sent to the tasks as bytes."""
    with open(path, "rb") as f:
        return f.read()


def _string_slices(column: pa.Array) -> Iterator[list[str]]:
    for part in tx.slices(pa.record_batch([column], names=["text"]), "text", SLICE_BYTES):
        yield [t or "" for t in part.column("text").to_pylist()]


def encode_column(data: bytes, threads: int = THREADS):
    """An Arrow UDF from text to ids; null counts as empty."""

    @F.arrow_udf("array<int>")
    def encode(column: pa.Array) -> pa.Array:
        parts = [pa.array(encode_batch(data, texts, threads), pa.list_(pa.int32())) for texts in _string_slices(column)]
        return pa.concat_arrays(parts) if parts else pa.array([], pa.list_(pa.int32()))

    return encode


def decode_column(data: bytes, threads: int = THREADS):
    """An Arrow UDF from ids to text; null counts as no ids."""

    @F.arrow_udf("string")
    def decode(column: pa.Array) -> pa.Array:
        return pa.array(decode_batch(data, [x or [] for x in column.to_pylist()], threads), pa.string())

    return decode


def _digest(data: bytes, threads: int, parity_every: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = None
        if parity_every:
            import sentencepiece

            reader = sentencepiece.SentencePieceProcessor(model_proto=data)
        model = SpmModel.parse(data)
        stands_for, prefix = model.piece_bytes(), int(model.dummy_prefix)
        kinds = np.array([k for _, _, k in model.pieces])
        for batch in batches:
            for part in tx.slices(batch, "text", SLICE_BYTES):
                texts = [t or "" for t in part.column("text").to_pylist()]
                ids = encode_batch(data, texts, threads)
                back = [b"".join([stands_for[i] for i in x]).decode(errors="replace")[prefix:] for x in ids]
                same: list[bool | None] = [None] * len(ids)
                if reader is not None:
                    checked = [k for k, t in enumerate(texts) if zlib.crc32(t.encode()) % parity_every == 0]
                    for k, theirs in zip(checked, reader.encode([texts[k] for k in checked], num_threads=1)):
                        same[k] = ids[k] == theirs
                arrays = [np.array(x, dtype=np.int32) for x in ids]
                yield pa.record_batch(
                    [
                        part.column("doc_id"),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([int((kinds[x] == BYTE).sum()) for x in arrays], pa.int64()),
                        pa.array([x.tobytes() for x in arrays], pa.binary()),
                        pa.array([b == t for b, t in zip(back, texts)], pa.bool_()),
                        pa.array(same, pa.bool_()),
                    ],
                    names=["doc_id", "n_tokens", "n_byte_tokens", "ids", "round_trip", "parity"],
                )

    return run


def encoded(
    docs: DataFrame, data: bytes, id_col: str = "doc_id", text_col: str = "text", threads: int = THREADS, parity_every: int = PARITY_EVERY
) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_byte_tokens`` (pieces that stand for a byte),
    ``ids`` (little-endian 32-bit integers), ``round_trip`` (the ids stand for the
    text again) and ``parity`` of every whole text. ``parity`` tells whether the
    SentencePiece library gives the same ids; that costs as much again as encoding.
    It is checked for every text, or with ``parity_every`` above 1 for one text of so
    many, chosen by the text's hash, and null for the others (0: for none).

    Null and empty texts have no ids, and ``round_trip`` holds. The pieces of control
    symbols are ordinary text. A model that squeezes or maps characters doesn't
    restore them, so ``round_trip`` may be false. Ids may repeat or be null; an empty
    table gives an empty result."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        _digest(data, threads, parity_every),
        "doc_id long, n_tokens long, n_byte_tokens long, ids binary, round_trip boolean, parity boolean",
    )
