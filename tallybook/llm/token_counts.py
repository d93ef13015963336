"""Token counts by a tokenizer compiled to finite-state transducers.

Two deterministic transducers count the tokens of a byte-level BPE file; its merges are never run on a text.

1. **Words.** Ten states over classes of characters follow the library's splitting pattern, and a transition tells whether a
   word starts at the character read or at the one before it. The texts of a batch are cut into chunks of equal length. Each
   chunk is a map from entry state to exit state; the maps are composed by a parallel prefix scan, doubling the distance in
   each round, so every chunk knows its entry state and all chunks are then run side by side. Characters' classes are asked of the
   library's own splitter, one by one.
2. **Tokens.** After the first n bytes of a word, BPE's tokens are those of some shorter beginning and one token more. A state is
   therefore what later bytes can still depend on: the suffixes that begin some token, and for each the token before it
   and the number of tokens up to it. A transition reads a byte and is annotated with the tokens it adds, which may be
   negative when a longer token replaces several. States are made when a text first needs them and are kept per task; words are
   run once per task and found again by a 64-bit hash.

Strings of added tokens inside texts are one token each and end the word before them, as the library has it by default.

A null text counts as empty: no bytes, no tokens. Repeated rows, null ids and columns of any name beside the two that are read
are passed over as they are: every input row gives one output row; an empty table gives none. A text without white space is one
long word, whose bytes the second transducer reads one after the other.
"""

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.byte_bpe import byte_characters
from tallybook.llm.common import PLAIN, slices, span_hashes, text_bytes

#: Characters of a chunk; states and words that a task keeps. The bounds are on memory and change no result.
CHUNK, KEPT_STATES, KEPT_WORDS = 128, 150_000, 1_000_000

# The classes of characters and the states of the word transducer.
(STMD, R, V, LL, E, LETTER, NUMBER, QUOTE, OTHER, SPACE, WHITE, END) = range(12)
(BEGIN, WORD, DIGITS, MARKS, APOSTROPHE, APOSTROPHE_R, APOSTROPHE_V, APOSTROPHE_L, AFTER_SPACE, AFTER_WHITE) = range(10)
CLASSES, STATES = 12, 10
HERE, BEFORE = 1, 2


def word_transducer() -> tuple[np.ndarray, np.ndarray]:
    """(next state, emitted) by class and state; emitted says whether a word starts here (1) or one character before (2)."""
    letters = (STMD, R, V, LL, E, LETTER)
    fresh = {**dict.fromkeys(letters, WORD), NUMBER: DIGITS, QUOTE: APOSTROPHE, OTHER: MARKS, SPACE: AFTER_SPACE,
             WHITE: AFTER_WHITE}
    going = np.zeros((CLASSES, STATES), dtype=np.uint8)
    emitted = np.zeros((CLASSES, STATES), dtype=np.uint8)

    def on(state, kinds, to, emit=0):
        for kind in kinds:
            going[kind, state], emitted[kind, state] = to, emit

    for kind, to in fresh.items():
        for state in (BEGIN, WORD, DIGITS, MARKS, APOSTROPHE):
            on(state, [kind], to, HERE)
        for state in (APOSTROPHE_R, APOSTROPHE_V, APOSTROPHE_L):  # no contraction: its letter was a word's first
            on(state, [kind], to, BEFORE | (0 if kind in letters else HERE))
        # the last white space of several stands alone, or goes with what follows if it is a space
        on(AFTER_SPACE, [kind], MARKS if kind == QUOTE else to, BEFORE)
        on(AFTER_WHITE, [kind], to, BEFORE | HERE)
    on(WORD, letters, WORD)
    on(DIGITS, [NUMBER], DIGITS)
    on(MARKS, [QUOTE, OTHER], MARKS)
    on(APOSTROPHE, [QUOTE, OTHER], MARKS)
    on(APOSTROPHE, [STMD], BEGIN)
    for kind, waiting, last in ((R, APOSTROPHE_R, E), (V, APOSTROPHE_V, E), (LL, APOSTROPHE_L, LL)):
        on(APOSTROPHE, [kind], waiting)
        on(waiting, [last], BEGIN)
    for state in (AFTER_SPACE, AFTER_WHITE):
        on(state, [SPACE], AFTER_SPACE)
        on(state, [WHITE], AFTER_WHITE)
    for state in range(STATES):
        on(state, [END], BEGIN, BEFORE if state in (APOSTROPHE_R, APOSTROPHE_V, APOSTROPHE_L) else 0)
    return going, emitted


@cache
def character_classes() -> bytes:
    """The class of every code point, as the library's splitter treats it: what it joins to a letter, a digit, a mark."""
    from tokenizers import pre_tokenizers

    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    points = np.array([p for p in range(0x110000) if not 0xD800 <= p < 0xE000])
    out = np.full(0x110000, WHITE, dtype=np.uint8)

    def joined(sample: str, runs: np.ndarray) -> np.ndarray:
        """Which of the runs of points, all of one length, are one word with the sample."""
        size, found = runs.shape[1], np.zeros(len(runs), dtype=bool)
        for first in range(0, len(runs), 1024):  # offsets of long texts cost the library more
            some = runs[first:first + 1024]
            words = split.pre_tokenize_str("".join(f"{sample}{''.join(map(chr, run))}\n" for run in some.tolist()))
            found[[first + at // (size + 2) for _, (at, to) in words if at % (size + 2) == 0 and to - at > size]] = True
        return found

    runs = points.reshape(-1, 64)
    for sample, kind in (("!", OTHER), ("x", LETTER)):  # most points stand among their like
        alike = joined(sample, runs)
        out[runs[alike]] = kind
        runs = runs[~alike]
    for sample, kind in (("!", OTHER), ("1", NUMBER), ("x", LETTER)):
        single = runs.reshape(-1, 1)
        out[single[joined(sample, single), 0]] = kind
    for letter, kind in zip("stmdrvle", (STMD,) * 4 + (R, V, LL, E)):
        out[ord(letter)] = kind
    out[ord("'")], out[ord(" ")] = QUOTE, SPACE
    return out.tobytes()


def entry_states(going: np.ndarray, chunks: np.ndarray) -> np.ndarray:
    """The state in which each chunk (a row of classes) is entered, the first in BEGIN.

    A chunk's map sends every entry state to its exit state. Maps of chunks 1, 2, 4 ... apart are composed until each
    covers all chunks before it.
    """
    table = going.reshape(-1)
    maps = np.tile(np.arange(STATES, dtype=np.uint8), (len(chunks), 1))
    for column in chunks.T:
        maps = table[column[:, None].astype(np.uint8) * np.uint8(STATES) + maps]
    distance = 1
    while distance < len(maps):
        later = np.take_along_axis(maps[distance:], maps[:-distance].astype(np.intp), axis=1)
        maps = np.concatenate([maps[:distance], later])
        distance *= 2
    return np.concatenate([np.full(1, BEGIN, np.uint8), maps[:-1, BEGIN]])


def word_starts(kinds: np.ndarray) -> np.ndarray:
    """Whether a word starts at each character of a run of classes; texts in it are parted by END."""
    going, emitted = word_transducer()
    n = len(kinds)
    chunks = np.full((-(-(n + 1) // CHUNK), CHUNK), END, dtype=np.uint8)  # an END at the end of the last text
    chunks.reshape(-1)[:n] = kinds
    state = entry_states(going, chunks)
    told = np.empty_like(chunks)
    for k, column in enumerate(np.ascontiguousarray(chunks.T)):
        at = column * np.uint8(STATES) + state
        told[:, k] = emitted.reshape(-1)[at]
        state = going.reshape(-1)[at]
    told = told.reshape(-1)
    starts = (told[:n] & HERE) > 0
    starts |= (told[1:n + 1] & BEFORE) > 0
    return starts


class TokenTransducer:
    """Numbers of tokens of words, by a transducer whose states are made when they are needed."""

    def __init__(self, model, vocabulary: dict[str, int]):
        byte = {character: b for b, character in byte_characters().items()}
        self.model, self.shown = model, {i: c for i, c in enumerate(byte_characters()[b] for b in range(256))}
        spelt = {bytes(byte[c] for c in token): i for token, i in vocabulary.items() if all(c in byte for c in token)}
        if any(bytes([b]) not in spelt for b in range(256)):
            raise ValueError("not a byte-level vocabulary: a byte has no token")
        #: Tokens that their own bytes give, and everything that a longer token begins with.
        self.tokens = {b: i for b, i in spelt.items() if len(b) == 1 or self._ids(b) == [i]}
        self.bytes = {i: b for b, i in self.tokens.items()}
        self.begins = {b[:n] for b in self.tokens for n in range(1, len(b))}
        self.fits: dict[tuple[int, int], bool] = {}
        self.forget()

    def _ids(self, data: bytes) -> list[int]:
        return [t.id for t in self.model.tokenize(data.decode("latin-1").translate(self.shown))]

    def forget(self) -> None:
        """Only the state before the first byte is left. A state lists (suffix, token before it, tokens up to it less those of all)."""
        start = ((b"", -1, 0),)
        self.states, self.number = [start], {start: 0}
        self.moves: dict[int, tuple[int, int]] = {}
        self.fits.clear()

    def _beside(self, before: int, token: int) -> bool:
        """Whether BPE leaves the two tokens side by side."""
        pair = before, token
        if pair not in self.fits:
            self.fits[pair] = self._ids(self.bytes[before] + self.bytes[token]) == [before, token]
        return self.fits[pair]

    def _move(self, state: int, byte: int) -> tuple[int, int]:
        """(next state, tokens added) of a transition, made now."""
        last = bytes([byte])
        read = [(suffix + last, before, upto) for suffix, before, upto in self.states[state]]
        token, added = next((self.tokens[s], upto + 1) for s, before, upto in read
                            if s in self.tokens and (before < 0 or self._beside(before, self.tokens[s])))
        after = (*((s, before, upto - added) for s, before, upto in read if s in self.begins), (b"", token, 0))
        to = self.number.setdefault(after, len(self.states))
        if to == len(self.states):
            self.states.append(after)
        self.moves[state << 8 | byte] = move = (to, added)
        return move

    def count(self, word: bytes) -> int:
        state = total = 0
        moves = self.moves
        for byte in word:
            move = moves.get(state << 8 | byte)
            if move is None:
                move = self._move(state, byte)
            state, added = move
            total += added
        return total


class Counter:
    """Token counts of whole texts by one tokenizer file, for use inside a task."""

    def __init__(self, path: str, classes: bytes):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        kept = json.loads(tokenizer.to_str())
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        if kept["normalizer"] or kept["truncation"] or kept["padding"] or {k: kept["pre_tokenizer"].get(k) for k in plain} != plain:
            raise ValueError(f"{path}: only byte-level BPE without normalizer, truncation and padding is compiled")
        added = tokenizer.get_added_tokens_decoder().values()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError(f"{path}: an added token takes more than its own string")
        self.added = sorted((t.content.encode() for t in added), key=len, reverse=True)
        self.classes = np.frombuffer(classes, np.uint8)
        self.words = TokenTransducer(tokenizer.model, tokenizer.get_vocab(with_added_tokens=False))
        self._forget()

    def _forget(self) -> None:
        self.known, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The number of tokens of each text."""
        whole = data.tobytes()
        leads = np.flatnonzero((data & 0xC0) != 0x80)  # the first byte of each character
        kinds = self.classes[np.frombuffer(whole.decode().encode("utf-32-le"), "<u4")]
        special = []
        for at, to in self._added(whole, offsets):
            kinds[np.searchsorted(leads, at):np.searchsorted(leads, to)] = END
            special.append((at, to))
        # an END character between texts: class and byte place of the characters, with the ENDs put in
        first = np.searchsorted(leads, offsets)
        starts = word_starts(np.insert(kinds, first[1:-1], END))
        starts = np.delete(starts, first[1:-1] + np.arange(len(offsets) - 2)) if len(offsets) > 2 else starts
        at = leads[np.flatnonzero(starts)]
        stops = np.sort(np.concatenate([at, offsets, np.array(special, np.int64).reshape(-1)]), kind="stable")
        ends = stops[np.searchsorted(stops, at, side="right")]
        upto = np.concatenate([[0], np.cumsum(self._count(data, at, ends))])
        found = np.searchsorted(np.sort(np.array([a for a, _ in special], np.int64)), offsets)
        return np.diff(upto[np.searchsorted(at, offsets)]) + np.diff(found)

    def _added(self, whole: bytes, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
        """Where strings of added tokens stand in texts, the leftmost first, of several the longest."""
        place = 0
        while True:
            here = [(at, -len(t)) for t in self.added if (at := whole.find(t, place)) >= 0]
            if not here:
                return
            at, size = min(here)
            place = at - size
            if np.searchsorted(offsets, at, side="right") == np.searchsorted(offsets, place, side="left"):
                yield at, place
            else:  # across two texts
                place = at + 1

    def _count(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each word."""
        if len(self.known) > KEPT_WORDS:
            self._forget()
        found, first, word = np.unique(span_hashes(data, starts, ends, PLAIN), return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.known, found), max(len(self.known) - 1, 0))
        new = self.known[place] != found if len(self.known) else np.ones(len(found), bool)
        made = []
        for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist()):
            if len(self.words.states) > KEPT_STATES:
                self.words.forget()
            made.append(self.words.count(data[a:b].tobytes()))
        keys = np.concatenate([self.known, found[new]])
        order = np.argsort(keys, kind="stable")
        self.known, self.counts = keys[order], np.concatenate([self.counts, np.array(made, np.int64)])[order]
        return self.counts[np.searchsorted(self.known, found)][word]


def count_tokens(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", limit: int = 512) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) per row; ``path`` is a tokenizer file that every worker can read."""
    classes = character_classes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(path, classes)
        for batch in batches:
            for part in slices(batch, text):
                data, offsets = text_bytes(part.column(text))
                yield pa.RecordBatch.from_arrays(
                    [part.column(key), pa.array(np.diff(offsets), pa.int64()), pa.array(counter(data, offsets), pa.int64())],
                    [key, "n_bytes", "n_tokens"])

    schema = T.StructType([docs.schema[key], T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])
    counted = docs.select(key, text).mapInArrow(run, schema)
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
