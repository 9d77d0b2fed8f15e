"""Operator 6: SentencePiece encoding and decoding on the tokenizers library.

The model file (a protobuf) is parsed here; normaliser, metaspace marker, unigram scores or merges, and byte
fallback are rebuilt as a ``tokenizers.Tokenizer``. Texts are cut where no piece can reach across (before a
run of markers that follows another character, which ``safe_to_cut`` verifies on the vocabulary), and each
distinct part of a chunk is encoded once, in multithreaded batches. Ids equal those of the library that
made the model; ``parity`` compares them.

A null or empty text has no tokens. Documents, nulls in other columns, repeated rows and further columns
pass through ``encode`` unchanged, one row out per row in; texts of any length are encoded whole.
"""

from __future__ import annotations

import re
import struct
from array import array
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from namebridge.llm import kernels as K
from namebridge.llm.stages import documents, small_batches

MARK = "▁"
#: The model that the query uses; any path may be given.
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Distinct parts in the younger half of a worker's memo; when it is full, it becomes the older half. Only a memory
#: bound: results do not depend on it.
MEMO = 150_000

# Numbers of the model file's fields and kinds.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, object]]:
    """(number, value) of each field of a protobuf message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = data[at]
            at += 1
            value |= (b & 127) << shift
            shift += 7
            if b < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind == 2:
            size = varint()
            yield key >> 3, data[at : at + size]
            at += size
        elif kind in (1, 5):
            size = 8 if kind == 1 else 4
            yield key >> 3, data[at : at + size]
            at += size
        else:
            raise ValueError(f"unexpected wire type {kind}")


def parse_model(data: bytes) -> dict:
    """pieces [(text, score, kind)], model kind, and the normaliser's settings."""
    model = {"pieces": [], "kind": UNIGRAM, "byte_fallback": False, "charsmap": b"", "prefix": True,
             "squeeze": True, "escape": True, "suffix_mark": False}
    for number, value in _fields(data):
        if number == 1:
            piece = {1: b"", 2: struct.pack("<f", 0.0), 3: NORMAL} | dict(_fields(value))
            model["pieces"].append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
        elif number == 2:
            spec = dict(_fields(value))
            model["kind"] = spec.get(3, UNIGRAM)
            model["byte_fallback"] = bool(spec.get(35, 0))
            model["suffix_mark"] = bool(spec.get(24, 0))
        elif number == 3:
            spec = dict(_fields(value))
            model |= {"charsmap": spec.get(2, b""), "prefix": bool(spec.get(3, 1)),
                      "squeeze": bool(spec.get(4, 1)), "escape": bool(spec.get(5, 1))}
    if model["kind"] not in (UNIGRAM, BPE) or model["suffix_mark"] or not model["escape"]:
        raise ValueError("only unigram and BPE models with a leading marker are supported")
    return model


def merges_of(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Pairs of pieces that join to a piece; those of better (larger) score first."""
    ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind in (NORMAL, UNUSED)}
    found = []
    for piece, i in ids.items():
        for k in range(1, len(piece)):
            left, right = piece[:k], piece[k:]
            if left in ids and right in ids:
                found.append((-pieces[i][1], ids[left], ids[right], left, right))
    return [(a, b) for _, _, _, a, b in sorted(found)]


def build(model: dict):
    """The tokenizer without a normaliser: parts come in normalised."""
    from tokenizers import Tokenizer, decoders, models

    pieces = model["pieces"]
    unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
    if model["kind"] == BPE:
        core = models.BPE(
            vocab={p: i for i, (p, _, _) in enumerate(pieces)}, merges=merges_of(pieces),
            unk_token=pieces[unknown][0], fuse_unk=True, byte_fallback=model["byte_fallback"])
    else:
        core = models.Unigram([(p, s) for p, s, _ in pieces], unknown, model["byte_fallback"])
    tokenizer = Tokenizer(core)
    tokenizer.decoder = decoders.Sequence(
        [decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse()])
    return tokenizer


def normaliser(model: dict):
    """Text to marked text: character map, blanks squeezed if the model says so, marker for blank and start."""
    charsmap = None
    if model["charsmap"]:
        from tokenizers import normalizers

        charsmap = normalizers.Precompiled(model["charsmap"])

    def run(text: str) -> str:
        if charsmap is not None:
            text = charsmap.normalize_str(text)
        if model["squeeze"]:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return ((" " + text) if model["prefix"] else text).replace(" ", MARK)

    return run


def safe_to_cut(model: dict) -> bool:
    """No piece has a marker behind another character, so no merge reaches across such a place."""
    return not any(re.search(f"[^{MARK}]{MARK}", p) for p, _, kind in model["pieces"] if kind != USER)


_PART = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")


class Codec:
    """Encodes and decodes lists of texts; one per worker process and model."""

    def __init__(self, data: bytes) -> None:
        self.model = parse_model(data)
        self.tokenizer = build(self.model)
        self.normalise = normaliser(self.model)
        self.cut = safe_to_cut(self.model)
        #: Ids of each part, by halves, and the parts that decoding does not give back.
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.lost: set[str] = set()
        #: What the library decodes each piece to; none for pieces whose neighbours matter, or that are no plain text.
        alone = [[i] for i in range(len(self.model["pieces"]))]
        self.texts = [
            text if kind == NORMAL and not piece.startswith("<0x") else None
            for text, (piece, _, kind) in zip(
                self.tokenizer.decode_batch(alone, skip_special_tokens=False), self.model["pieces"], strict=True)]

    def _learn(self, parts: list[str]) -> None:
        encoded = self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)
        texts, memo, open_ = self.texts, self.memo, []
        for part, e in zip(parts, encoded, strict=True):
            ids = e.ids
            memo[part] = array("i", ids).tobytes()
            try:
                if "".join([texts[i] for i in ids]) != part.replace(MARK, " "):
                    self.lost.add(part)
            except TypeError:  # bytes and unknown characters are decoded together
                open_.append((part, ids))
        back = self.tokenizer.decode_batch([ids for _, ids in open_], skip_special_tokens=False)
        self.lost.update(part for (part, _), b in zip(open_, back, strict=True) if b != part.replace(MARK, " "))

    def _remember(self, wanted: set[str]) -> None:
        """All wanted parts are in the younger half then."""
        new = wanted - self.memo.keys()
        if len(self.memo) + len(new) > MEMO:
            self.older, self.memo, new = self.memo, {}, wanted
            self.lost.intersection_update(self.older)
        known = new & self.older.keys()
        self.memo.update((p, self.older[p]) for p in known)
        missing = list(new - known)
        for at in range(0, len(missing), 1 << 13):  # encodings are large
            self._learn(missing[at : at + (1 << 13)])

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, bool]]:
        """Ids of each text, and whether decoding them gives the normalised text back."""
        split = []
        for text in texts:
            marked = self.normalise(text or "")
            split.append((_PART.findall(marked) if self.cut else [marked]) if marked else [])
        self._remember(set().union(*split))
        out = []
        memo = self.memo
        for parts in split:
            ids = np.frombuffer(b"".join([memo[p] for p in parts]), np.int32)
            out.append((ids, not self.lost or self.lost.isdisjoint(parts)))
        return out

    def decode(self, rows: list[list[int]]) -> list[str]:
        texts = self.tokenizer.decode_batch([list(r) for r in rows], skip_special_tokens=False)
        return [t[1:] if self.model["prefix"] and t.startswith(" ") else t for t in texts]


def codec(data: bytes) -> Codec:
    return K.kept(data, lambda: Codec(data))


def model_bytes(path: str = MODEL) -> bytes:
    with open(path, "rb") as file:  # read where the job is planned; workers get the bytes
        return file.read()


def parity(texts: list[str], path: str = MODEL) -> list[int]:
    """Positions of the texts whose ids differ from the reference library's."""
    import sentencepiece

    theirs = sentencepiece.SentencePieceProcessor(model_file=path).encode(texts, num_threads=1)
    ours = codec(model_bytes(path)).encode(texts)
    return [i for i, (a, b) in enumerate(zip(ours, theirs, strict=True)) if a[0].tolist() != b]


def _groups(texts: pa.Array, limit: int = 2 << 20) -> Iterator[list[str | None]]:
    group, size = [], 0
    for text in texts.to_pylist():
        group.append(text)
        size += len(text or "")
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group


def encode(docs: DataFrame, path: str = MODEL, ids: bool = True) -> DataFrame:
    """docs with n_tokens, ids_crc32 (of the ids as little-endian 32-bit integers), round_trip, and token_ids."""
    small_batches(docs.sparkSession)
    data = model_bytes(path)
    extra = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_crc32", T.LongType()),
             T.StructField("round_trip", T.BooleanType())]
    if ids:
        extra.append(T.StructField("token_ids", T.ArrayType(T.IntegerType())))
    names = {f.name for f in extra}
    kept = docs.drop(*names)
    schema = T.StructType([*kept.schema.fields, *extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(data)
        for batch in batches:
            at = 0
            for group in _groups(batch.column("text")):
                got = c.encode(group)
                columns = [*batch.slice(at, len(group)).columns,
                           pa.array([len(i) for i, _ in got], pa.int64()),
                           pa.array([zlib.crc32(i.astype("<i4").tobytes()) for i, _ in got], pa.int64()),
                           pa.array([ok for _, ok in got], pa.bool_())]
                if ids:
                    offsets = np.concatenate([[0], np.cumsum([len(i) for i, _ in got])]).astype(np.int32)
                    flat = np.concatenate([i for i, _ in got]) if got else np.zeros(0, np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)
                at += len(group)

    return kept.mapInArrow(K.tidy(run, keeps=True), schema)


def decode(encoded: DataFrame, path: str = MODEL) -> DataFrame:
    """encoded with decoded_text, from token_ids."""
    data = model_bytes(path)
    kept = encoded.drop("decoded_text")
    schema = T.StructType([*kept.schema.fields, T.StructField("decoded_text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(data)
        for batch in batches:
            texts = c.decode([r or [] for r in batch.column("token_ids").to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=schema.names)

    return kept.mapInArrow(K.tidy(run, keeps=True), schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, round_trip, token_ids of every document."""
    return encode(documents(spark, sf_dir).select("doc_id", "text")).drop("text")
