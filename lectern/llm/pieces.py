"""Exact merge-type encoding by backtracking, and decoding (operator 6)."""

from __future__ import annotations

import codecs
import hashlib
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import relieved, table
from lectern.llm.tokens import vocabulary

SPACE = "▁"
#: Chunks and pairs of pieces that a worker keeps; reaching it, the worker starts anew.
CACHED = 600_000
#: Longer chunks are encoded each time.
CACHED_CHARS = 64

DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PieceCodec:
    """Encodes and decodes as a merge-type piece model does.

    A sequence of pieces is the merge result exactly if merging each two neighbours' text anew gives those two
    back. So the longest piece that starts at each place is taken (all pieces in a text are found by one
    Aho-Corasick pass), checked against the piece before it, and shortened where the check fails; a place from
    which no piece leads on is marked in a bitfield and never tried again. Characters without a piece end up
    as their UTF-8 bytes and take part in no merge."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, kinds = model.normalizer_spec, pb.ModelProto.SentencePiece
        if model.trainer_spec.model_type != pb.TrainerSpec.BPE or spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or not model.trainer_spec.byte_fallback:
            raise ValueError("only merge-type models with byte fallback and without a character map are supported")
        if any(p.type in (kinds.USER_DEFINED, kinds.UNUSED) for p in model.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.prefix = spec.add_dummy_prefix
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == kinds.NORMAL}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == kinds.BYTE}
        self.raw = {i: b"" for i in range(len(model.pieces))}
        self.raw |= {i: p.replace(SPACE, " ").encode() for p, i in self.ids.items()}
        self.raw |= {i: bytes([b]) for b, i in self.byte_ids.items()}
        self.raw[next(i for i, p in enumerate(model.pieces) if p.type == kinds.UNKNOWN)] = model.trainer_spec.unk_surface.encode()
        self.found = ahocorasick.Automaton()
        for piece in self.ids:
            self.found.add_word(piece, len(piece))
        self.found.make_automaton()
        # Where no piece has the space sign after another character, a merge never reaches over the start of a run of
        # signs; nor over a character that has no piece. Both part a text into chunks.
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            self.chunks = re.compile(r"(?s).+")
        elif "\n" in "".join(self.ids):
            self.chunks = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        else:
            self.chunks = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")
        self.signed = {i for p, i in self.ids.items() if p.startswith(SPACE)}
        self.joined = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        self.known: dict[str, tuple[bytes, int, bytes]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}

    def merged(self, text: str) -> list[str]:
        """The merge result of a short text: the best pair by score, the leftmost of equals, until none is left."""
        parts, scores = list(text), self.scores
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def agree(self, left: str, right: str) -> bool:
        """Whether left (empty at the start) and right can be neighbours."""
        if (left, right) not in self.pairs:
            if len(self.pairs) > CACHED:
                self.pairs.clear()
            self.pairs[left, right] = self.merged(left + right) == [x for x in (left, right) if x]
        return self.pairs[left, right]

    def tokens(self, text: str) -> list[str]:
        """Pieces of a chunk, and characters that have none."""
        starts: list[list[int]] = [[] for _ in text]
        for end, length in self.found.iter(text):
            starts[end - length + 1].append(length)  # shortest first, as ends come in order
        out: list[str] = []
        tried: list[int] = []  # by token: which of the lengths at its start
        failed, at, turn = 0, 0, None
        while at < len(text):
            lengths = starts[at]
            if not lengths:
                out.append(text[at])
                tried.append(0)
                at, turn = at + 1, None
                continue
            k = len(lengths) - 1 if turn is None else turn
            before = out[-1] if out and out[-1] in self.ids else ""
            while k >= 0:
                end = at + lengths[k]
                if not failed >> end & 1 and self.agree(before, text[at:end]):
                    break
                k -= 1
            if k >= 0:
                out.append(text[at:end])
                tried.append(k)
                at, turn = end, None
            else:
                failed |= 1 << at
                at -= len(out.pop())  # a single character's own piece always follows some piece, so out isn't empty
                turn = tried.pop() - 1
        return out

    def chunk(self, text: str) -> tuple[bytes, int, bytes]:
        """Decimal ids, each with a comma after it, their number, and the decoded bytes. Two characters that are
        neighbours in no piece part a chunk once more: a word and its comma, say."""
        joined, at, got = self.joined, 0, []
        for i in range(1, len(text)):
            if text[i - 1 : i + 1] not in joined:
                got.append(self.core(text[at:i]))
                at = i
        got.append(self.core(text[at:]))
        return got[0] if len(got) == 1 else (b"".join([x[0] for x in got]), sum([x[1] for x in got]), b"".join([x[2] for x in got]))

    def core(self, text: str) -> tuple[bytes, int, bytes]:
        if (got := self.known.get(text)) is not None:
            return got
        ids: list[int] = []
        for x in self.tokens(text):
            ids += [self.ids[x]] if x in self.ids else [self.byte_ids[b] for b in x.encode()]
        got = b"".join([b"%d," % i for i in ids]), len(ids), b"".join(map(self.raw.__getitem__, ids))
        if len(text) <= CACHED_CHARS:
            self.known[text] = got
        return got

    def parts(self, text: str) -> list[tuple[bytes, int, bytes]]:
        if not text:
            return []
        out, known = [], self.known
        if len(known) > CACHED:
            known.clear()
        for x in self.chunks.findall(SPACE * self.prefix + text.replace(" ", SPACE)):
            if (got := known.get(x)) is None:
                got = self.chunk(x)
                if len(x) <= CACHED_CHARS:
                    known[x] = got
            out.append(got)
        return out

    def encode(self, text: str) -> list[int]:
        return [int(x) for p in self.parts(text) for x in p[0].split(b",")[:-1]]

    def decode(self, ids: Iterable[int]) -> str:
        ids = list(ids)
        raw = b"".join(map(self.raw.__getitem__, ids))
        return self.shown(raw) if ids and ids[0] in self.signed else raw.decode("utf-8", "each_byte")

    def shown(self, raw: bytes) -> str:
        """The text of decoded bytes: without the space put before it, U+FFFD for each byte that is none."""
        return raw[self.prefix and raw[:1] == b" " :].decode("utf-8", "each_byte")


codecs.register_error("each_byte", lambda e: ("\ufffd" * (e.end - e.start), e.end))
_codecs: dict[str, PieceCodec] = {}


def codec(path: str) -> PieceCodec:
    if path not in _codecs:
        _codecs[path] = PieceCodec(path)
    return _codecs[path]


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids, decoded) of whole texts; a null text counts as empty and has no ids."""
    path = path or vocabulary("piece_bpe_32k.model")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            ids = [own.encode(x or "") for x in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32())), pa.array([own.decode(x) for x in ids], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "decoded"])

    return _whole(docs).mapInArrow(relieved(run), "doc_id long, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of whole texts, of any length, in time that grows with it, without
    white space too; a null text counts as empty. A row of docs gives a row, repeated or not. An empty table gives none;
    other columns, whatever their names, play no part."""
    path = path or vocabulary("piece_bpe_32k.model")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in batches:
            n, ids, decoded = [], [], []
            for text in batch.column("text"):
                parts = own.parts(text.as_py() or "")
                n.append(sum([p[1] for p in parts]))
                ids.append(hashlib.sha256(b"".join([p[0] for p in parts])[:-1]).hexdigest())
                decoded.append(hashlib.sha256(own.shown(b"".join([p[2] for p in parts])).encode()).hexdigest())
            columns = [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in DIGEST.split(", ")])

    return _whole(docs).mapInArrow(relieved(run), DIGEST)


def _whole(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))
