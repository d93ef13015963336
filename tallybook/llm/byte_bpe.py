"""Byte-level BPE: whole texts to token ids with offsets, and ids back to the exact bytes.

The `tokenizers` library does the merges. Texts are first cut where no token
crosses, mostly into words, and equal pieces are encoded once per task: prose
repeats its words, so most of a text is looked up.

A null text counts as empty and gives no ids. Repeated rows, null ids and columns
of any name beside the two that are read are passed over as they are: every input
row gives one output row. A text without white space is one piece, however long.
"""

import base64
import hashlib
import os
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallybook.llm.common import PLAIN, slices, span_hashes, text_bytes

#: Distinct pieces and their ids that a task keeps; the bounds are on memory and change no result.
KEPT_PIECES, KEPT_IDS = 1_500_000, 12_000_000


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself if it prints, else one past 255."""
    printed = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in printed)
    return {b: chr(b) for b in printed} | {b: chr(256 + i) for i, b in enumerate(others)}


def tokenizer_of_ranks(path: str):
    """A tokenizer of the `tokenizers` library that merges as a file of ranks says.

    Any two neighbours whose bytes together are a token may merge, the lowest
    rank first; so each token gets a merge for every way to split it in two.
    """
    from tokenizers import Tokenizer, models, pre_tokenizers

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    shown = byte_characters()
    name = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = [(name[token[:i]], name[token[i:]]) for token in sorted(ranks, key=ranks.get)
              for i in range(len(token) - 1, 0, -1) if token[:i] in ranks and token[i:] in ranks]
    tokenizer = Tokenizer(models.BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    return tokenizer


def tokenizer_of_json(path: str):
    """A tokenizer file of the library as it is: the string of an added token in a text is that token."""
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _classes(*spans) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for first, last in spans:
        out[first:last + 1] = True
    return out


_LETTER = _classes((0x41, 0x5A), (0x61, 0x7A))
_MARK = _classes((0x21, 0x26), (0x28, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))  # all but the apostrophe
_SOLID = ~_classes((0x09, 0x0D), (0x20, 0x20), (0x80, 0xFF)) & _classes((0x00, 0x7F))
#: First bytes of characters that are no white space: not ASCII's, nor one that some white space begins with.
_NO_WHITE = ~_classes((0x09, 0x0D), (0x20, 0x20), (0xC2, 0xC2), (0xE1, 0xE3))


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where texts can be cut so that no token of the byte-level pattern crosses.

    A cut is made at the start of every text, before a space that a word of the same
    text follows, around a single line break, and between ASCII letters and marks.
    """
    cut = np.zeros(len(data) + 2, dtype=bool)
    if len(data) > 1:
        here, before = data[1:], data[:-1]
        cut[:len(data) - 1] |= (before == 0x20) & _NO_WHITE[here]
        last = np.asarray(offsets)
        cut[last[last > 0] - 1] = False  # a text's last space may belong with those before it
        cut[1:len(data)] |= (_LETTER[before] & _MARK[here]) | (_MARK[before] & _LETTER[here])
        breaks = (data[1:-1] == 0x0A) & _SOLID[data[:-2]] & _NO_WHITE[data[2:]]
        cut[1:len(data) - 1] |= breaks
        cut[2:len(data)] |= breaks
    cut[offsets] = True
    return np.flatnonzero(cut[:len(data)])


class Encoder:
    """Ids of whole texts by one byte-level tokenizer, for use inside a task.

    Texts are cut into pieces, and a piece that came before is not encoded again.
    """

    def __init__(self, tokenizer):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer, self.model = tokenizer, tokenizer.model
        added = [] if tokenizer.encode_special_tokens else [*tokenizer.get_added_tokens_decoder().values()]
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            raise ValueError("added tokens that look at what stands beside them are not supported")
        self.added = {t.content for t in added}
        longest = sorted((content.encode() for content in self.added), key=len, reverse=True)
        self.find_added = re.compile(b"|".join(map(re.escape, longest))).finditer if longest else None
        self.shown = {i: c for i, c in enumerate(byte_characters()[b] for b in range(256))}
        self._forget()

    def _forget(self) -> None:
        """Known pieces: their sorted hashes, and where their ids begin and end in one array of ids."""
        self.keys, self.at, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, "<u4")

    def _encode(self, piece: str) -> list[int]:
        letters = piece[1:] if piece[0] == " " else piece
        if piece not in self.added and letters.isalpha() and max(letters) < "\u0250":  # one match of the pattern: straight to the merges
            return [t.id for t in self.model.tokenize(piece.encode().decode("latin-1").translate(self.shown))]
        return self.tokenizer.encode(piece, add_special_tokens=False).ids

    def _learn(self, hashes: np.ndarray, pieces: list[str]) -> None:
        made = [self._encode(piece) for piece in pieces]
        size = np.array([len(ids) for ids in made], dtype=np.int64)
        at = len(self.ids) + np.cumsum(size) - size
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(made), "<u4", int(size.sum()))])
        keys = np.concatenate([self.keys, hashes])
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.at, self.size = np.concatenate([self.at, at])[order], np.concatenate([self.size, size])[order]

    def _starts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where pieces start: added tokens are pieces, and what stands between them is cut as texts are."""
        found: list[tuple[int, int]] = []
        if self.find_added and len(data):
            whole = data.tobytes()
            for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
                found += [m.span() for m in self.find_added(whole, a, b)]
        if not found:
            return piece_starts(data, offsets)
        spans = np.array(found, dtype=np.int64)
        starts = piece_starts(data, np.unique(np.concatenate([offsets, spans.reshape(-1)])))
        token = np.searchsorted(spans[:, 0], starts, side="left") - 1  # the last that begins before
        return starts[(token < 0) | (starts >= spans[token, 1])]

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's begin."""
        if len(self.keys) > KEPT_PIECES or len(self.ids) > KEPT_IDS:
            self._forget()
        starts = self._starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        found, first, piece = np.unique(span_hashes(data, starts, ends, PLAIN), return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, found)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == found[known]
        if not known.all():
            new = first[~known]
            self._learn(found[~known], [data[a:b].tobytes().decode() for a, b in zip(starts[new], ends[new])])
            place = np.searchsorted(self.keys, found)
        at, size = self.at[place][piece], self.size[place][piece]
        upto = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(at - upto[:-1], size) + np.arange(upto[-1])]
        return ids, upto[np.searchsorted(starts, offsets)]


def token_bytes(tokenizer) -> list[bytes]:
    """The bytes of every id: the reverse of the byte-to-character table."""
    byte = {character: b for b, character in byte_characters().items()}
    out = [b""] * tokenizer.get_vocab_size()
    special = tokenizer.get_added_tokens_decoder()
    for token, i in tokenizer.get_vocab().items():
        out[i] = token.encode() if i in special else bytes(byte[c] for c in token)
    return out


def character_offsets(ids: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Per token the first character it has bytes of and the place after its last, and how many begin inside one."""
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    begins = (data & 0xC0) != 0x80  # the first byte of each character
    upto = np.concatenate([[0], np.cumsum(begins)])
    inside = ~begins[starts] if len(starts) else np.zeros(0, bool)
    return (upto[starts] - inside).astype("<u4"), upto[ends].astype("<u4"), int(inside.sum())


def _encoded(tokenizer, batches: Iterator[pa.RecordBatch], text: str, names: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches with the columns of ``encode``, the key's being the first of ``names``."""
    encoder, lengths = Encoder(tokenizer), np.array([len(b) for b in token_bytes(tokenizer)])
    types = [pa.int64(), pa.binary(), pa.int64(), pa.binary(), pa.binary()]
    for batch in batches:
        for part in slices(batch, text):
            data, at = text_bytes(part.column(text))
            ids, upto = encoder(data, at)
            rows = []
            for a, b, i, j in zip(at, at[1:], upto, upto[1:]):
                starts, ends, split = character_offsets(ids[i:j], data[a:b], lengths)
                rows.append((j - i, ids[i:j].tobytes(), split, starts.tobytes(), ends.tobytes()))
            made = [pa.array(c, t) for c, t in zip(zip(*rows), types)][:len(names) - 1]
            yield pa.RecordBatch.from_arrays([part.column(names[0]), *made], names)


def _decoded(table: list[bytes], batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[pa.RecordBatch]:
    """Batches with ``columns`` and the bytes of their ids; ``table`` has the bytes of every id."""
    for batch in batches:
        for first in range(0, len(batch), 64):
            part = batch.slice(first, 64)
            made = [b"".join(map(table.__getitem__, np.frombuffer(ids or b"", "<u4").tolist()))
                    for ids in part.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in columns), pa.array(made, pa.binary())],
                                             [*columns, "decoded"])


def encode(docs: DataFrame, load: Callable[[], object], key: str = "doc_id", text: str = "text",
           offsets: bool = True) -> DataFrame:
    """(key, n_tokens, ids, n_split[, starts, ends]) per row; ids and offsets are little-endian unsigned 32-bit.

    ``load`` makes the tokenizer inside a task. Offsets count characters of the
    text; a token that has only part of a character covers that character.
    ``n_split`` counts the tokens that begin inside a character.
    """
    names = [key, "n_tokens", "ids", "n_split", *(["starts", "ends"] if offsets else [])]
    kinds = [docs.schema[key].dataType, T.LongType(), T.BinaryType(), T.LongType(), T.BinaryType(), T.BinaryType()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _encoded(load(), batches, text, names)

    schema = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds)])
    return docs.select(key, text).mapInArrow(run, schema)


def decode(encoded: DataFrame, load: Callable[[], object], key: str = "doc_id", carry: Iterable[str] = ()) -> DataFrame:
    """(key, carried columns, decoded) per row: the bytes of its ids, also where they end inside a character.

    Bytes of any run of ids can be joined to those of the next; ``decoded_text``
    makes text of them. Null ids count as none.
    """
    columns = [key, *carry]
    schema = T.StructType([*(encoded.schema[c] for c in columns), T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _decoded(token_bytes(load()), batches, columns)

    return encoded.select("ids", *columns).mapInArrow(run, schema)


def decoded_text(pieces: Iterable[bytes]) -> Iterator[str]:
    """Text of byte pieces in order; a character split between pieces comes with the piece that ends it."""
    import codecs

    decoder = codecs.getincrementaldecoder("utf-8")(errors="replace")
    pieces = list(pieces)
    for piece, last in zip(pieces, chain(repeat(False, len(pieces) - 1), [True])):
        yield decoder.decode(piece, last)


def tokens_report(docs: DataFrame, load: Callable[[], object], key: str = "doc_id", text: str = "text") -> DataFrame:
    """Digests of every row's ids, of the bytes they decode to and of the tokens' places (all starts, then all ends).

    Texts are encoded and decoded in one task, so that neither ids nor bytes go through the JVM.
    """
    names = [key, "n_tokens", "ids", "n_split", "starts", "ends"]
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), *(T.StructField(n, k) for n, k in (
        ("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType()),
        ("n_split", T.LongType()), ("offsets_sha256", T.StringType())))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load()
        for part in _decoded(token_bytes(tokenizer), _encoded(tokenizer, batches, text, names), names):
            ids, decoded, *places = (part.column(c).to_pylist() for c in ("ids", "decoded", "starts", "ends"))
            digests = [pa.array([hashlib.sha256(x).hexdigest() for x in of])
                       for of in (ids, decoded, (a + b for a, b in zip(*places)))]
            yield pa.RecordBatch.from_arrays(
                [part.column(key), part.column("n_tokens"), *digests[:2], part.column("n_split"), digests[2]], schema.names)

    return docs.select(key, text).mapInArrow(run, schema)
