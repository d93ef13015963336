"""Personal data in whole texts: plain patterns, and a linear-chain conditional random field for what they miss.

The patterns find e-mail addresses, IP addresses, card numbers that pass the Luhn
check and international phone numbers. The field adds such data in other dress: phone
numbers without a country code, cards in odd groups, addresses in brackets. A card that it
adds passes the Luhn check too, which its features see and its spans must hold. It tags words; only
a word with a digit or an at sign can be tagged, so words between decode apart and a
text costs little more than the search for such words. It is trained on a small
labelled table by maximum likelihood and goes to the tasks as one small matrix.

A null text counts as empty and has no spans. Positions count characters, ends are
exclusive. Every input row gives one output row, so repeated rows and null ids are
passed through; an empty table gives no rows, and columns beside the two that are read may have
any name. The search is linear in the text's length, whatever it holds; only the shape that the
field sees of a word is cut, at 64 characters and 24 signs, never a span.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallybook.llm.common import slices

# The kinds in order, the patterns and the limits on what they find.
KINDS = ("email", "ip", "card", "phone")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARKED = re.compile(r"[0-9@]")

Span = tuple[str, int, int]


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each at sign to both sides, so that long words without one cost nothing."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            end = found.end()
            yield start, end
        at = text.find("@", max(end, at + 1))


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else sum(divmod(2 * v, 10)) for i, v in enumerate(values)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """What the patterns find: leftmost, non-overlapping within a kind, in order of kind and place."""
    spans = [("email", a, b) for a, b in emails(text)]
    if _MARKED.search(text) is None:
        return spans
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") or "0" for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p) <= 255 for p in parts):
            spans.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m.group()) <= 15:
            spans.append(("phone", *m.span()))
    return spans


# ---- the field

TAGS = ("O", *(f"{edge}-{kind}" for kind in KINDS for edge in "BI"))
_CUES = {"phone": "phone", "tel": "phone", "telephone": "phone", "call": "phone", "fax": "phone", "mobile": "phone",
         "card": "card", "visa": "card", "mastercard": "card", "amex": "card", "ip": "ip", "host": "ip",
         "server": "ip", "address": "address", "mail": "email", "email": "email", "e-mail": "email",
         "version": "version", "section": "version", "page": "version", "no": "version", "year": "version"}
_OUTER = "\"'.,;:!?<>{}|*#=&%$"


@dataclass
class Word:
    text: str
    start: int


def _words(text: str) -> Iterator[list[Word]]:
    """The words of each line that has a digit or an at sign."""
    at = 0
    for line in text.split("\n"):
        if _MARKED.search(line):
            yield [Word(m.group(), at + m.start()) for m in re.finditer(r"\S+", line)]
        at += len(line) + 1


def shape(word: str) -> str:
    """Runs of digits as 9 and their count, of letters as a or A; other signs as they are; cut at 24 signs."""
    out = []
    for kind, run in groupby(word[:64], key=lambda c: "9" if c.isdigit() else "A" if c.isupper() else
                             "a" if c.isalpha() else c):
        n = sum(1 for _ in run)
        out.append(f"9{min(n, 20)}" if kind == "9" else kind)
    return "".join(out)[:24]


def luhn_near(words: list[Word], i: int) -> str:
    """Whether word i is in a stretch of digit groups that together are a valid card, in one that is none, or in none at all.

    Groups have four digits at least, so a stretch is of four words at most.
    """
    groups = {}
    for j in range(max(0, i - 3), min(len(words), i + 4)):
        core = words[j].text.strip(_OUTER).replace("-", "")
        if core.isascii() and core.isdigit() and 4 <= len(core) <= 19:
            groups[j] = core
    told = "none"
    for a in range(max(0, i - 3), i + 1):
        digits = ""
        for b in range(a, min(len(words), a + 4)):
            if b not in groups:
                break
            digits += groups[b]
            if b >= i and 13 <= len(digits) <= 19:
                if luhn(digits):
                    return "valid"
                told = "wrong"
    return told


def features(words: list[Word], i: int) -> list[str]:
    """What the field sees of word i: its shape, signs and length, whether its digits check, and the shapes and cues beside it."""
    core = words[i].text.strip(_OUTER)
    digits = sum(c.isdigit() for c in core)
    letters = any(c.isalpha() for c in core)
    signs = "".join(sorted({c for c in core if not c.isalnum()}))[:6]
    out = ["all", f"shape={shape(core)}", f"signs={signs}", f"digits={min(digits, 20)}", f"letters={letters}",
           f"signs+digits={signs}{min(digits, 20)}{letters}", f"dots={min(core.count('.'), 4)}",
           f"luhn={luhn_near(words, i) if digits >= 4 else 'none'}"]
    for step, name in ((-1, "before"), (1, "after")):
        j = i + step
        near = words[j].text.strip(_OUTER) if 0 <= j < len(words) else ""
        marked = bool(near) and bool(_MARKED.search(near))
        out.append(f"{name}={shape(near) if marked else 'word' if near else 'none'}")
    for j in range(max(0, i - 3), i):
        cue = _CUES.get(words[j].text.strip(_OUTER).lower())
        out += [f"cue={cue}", f"cue={cue},letters={letters},digits={digits >= 7}"] if cue else []
    return out


def runs(words: list[Word]) -> Iterator[tuple[int, int]]:
    """Stretches of words that can be tagged."""
    marked = [bool(_MARKED.search(w.text)) for w in words]
    i = 0
    for is_marked, group in groupby(marked):
        n = sum(1 for _ in group)
        if is_marked:
            yield i, i + n
        i += n


def _allowed() -> np.ndarray:
    """Scores of tag pairs that cannot be (an inside tag after another kind): far below all others."""
    out = np.zeros((len(TAGS) + 1, len(TAGS)))  # the last row: before the first word of a run
    for j, tag in enumerate(TAGS):
        if tag[0] == "I":
            out[:, j] = -1e6
            out[[TAGS.index(f"B-{tag[2:]}"), j], j] = 0
    return out


@dataclass
class Field:
    """A trained field: the number of each feature, its weight per tag, and the scores of tag pairs."""

    number: dict[str, int]
    weights: np.ndarray
    pairs: np.ndarray

    def scores(self, seen: list[list[str]]) -> np.ndarray:
        out = np.zeros((len(seen), len(TAGS)))
        for i, names in enumerate(seen):
            out[i] = self.weights[[self.number[n] for n in names if n in self.number]].sum(axis=0)
        return out

    def decode(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """The best tags of every sequence by Viterbi, all sequences of like length at once; ties to the first tag."""
        out: list = [None] * len(sequences)
        order = sorted(range(len(sequences)), key=lambda i: len(sequences[i]))
        for _, group in groupby(order, key=lambda i: len(sequences[i]).bit_length()):
            group = list(group)
            for k in range(0, len(group), 4096):
                part = group[k:k + 4096]
                for i, tags in zip(part, self._viterbi([sequences[i] for i in part])):
                    out[i] = tags
        return out

    def _viterbi(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        size = np.array([len(s) for s in sequences])
        scores = np.zeros((len(sequences), size.max(), len(TAGS)))
        for i, s in enumerate(sequences):
            scores[i, :len(s)] = s
        best = scores[:, 0] + self.pairs[-1]
        back = np.zeros((size.max(), len(sequences), len(TAGS)), dtype=np.int8)
        for t in range(1, size.max()):
            ways = best[:, :, None] + self.pairs[None, :-1]
            back[t] = ways.argmax(axis=1)
            best = np.where((t < size)[:, None], ways.max(axis=1) + scores[:, t], best)
        tag = best.argmax(axis=1)
        tags = np.zeros((len(sequences), size.max()), dtype=np.int8)
        for t in range(size.max() - 1, -1, -1):
            last = t < size
            tags[last, t] = tag[last]
            if t:
                tag = np.where(last, back[t][np.arange(len(sequences)), tag], tag)
        return [tags[i, :n] for i, n in enumerate(size)]


def train(labelled: list[tuple[str, list[Span]]], steps: int = 200, rate: float = 0.2, decay: float = 0.002) -> Field:
    """Fit by gradient steps on the mean log-likelihood of (text, spans) rows, by forward and backward sums."""
    sequences, answers, number = [], [], {}
    for text, spans in labelled:
        for words in _words(text):
            tags = [_tag(word, spans) for word in words]
            for a, b in runs(words):
                seen = [features(words, i) for i in range(a, b)]
                sequences.append([[number.setdefault(n, len(number)) for n in names] for names in seen])
                answers.append([TAGS.index(t) for t in tags[a:b]])
    if not sequences:
        return Field({}, np.zeros((0, len(TAGS))), _allowed())
    n, longest, k = len(sequences), max(map(len, sequences)), len(TAGS)
    at = np.array([(i, t, f) for i, s in enumerate(sequences) for t, names in enumerate(s) for f in names])
    size, barred = np.array([len(s) for s in sequences]), _allowed()
    truth = np.zeros((n, longest, k))
    true_pairs = np.zeros((k + 1, k))
    for i, tags in enumerate(answers):
        truth[i, np.arange(len(tags)), tags] = 1
        for before, tag in zip([k, *tags], tags):
            true_pairs[before, tag] += 1
    weights, pairs = np.zeros((len(number), k)), np.zeros((k + 1, k))
    sums = [np.full_like(weights, 1e-8), np.full_like(pairs, 1e-8)]
    for _ in range(steps):
        scores = np.zeros((n, longest, k))
        np.add.at(scores, (at[:, 0], at[:, 1]), weights[at[:, 2]])
        near, near_pairs = _expected(scores, pairs + barred, size)
        wrong = truth - near
        slope = np.zeros_like(weights)
        np.add.at(slope, at[:, 2], wrong[at[:, 0], at[:, 1]])
        for value, step, total in ((weights, slope / n - decay * weights, sums[0]),
                                   (pairs, (true_pairs - near_pairs) / n - decay * pairs, sums[1])):
            total += step**2
            value += rate * step / np.sqrt(total)
    return Field(number, weights, pairs + barred)


def _expected(scores: np.ndarray, pairs: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Chances of each tag at each word, and expected counts of tag pairs, under the field."""
    n, longest, k = scores.shape
    inside = np.arange(longest)[None] < size[:, None]
    total = lambda x, axis: np.log(np.exp(x - (m := x.max(axis=axis, keepdims=True))).sum(axis=axis)) + m.squeeze(axis)
    ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
    ahead[:, 0] = scores[:, 0] + pairs[-1]
    for t in range(1, longest):
        moved = total(ahead[:, t - 1, :, None] + pairs[None, :-1], 1) + scores[:, t]
        ahead[:, t] = np.where(inside[:, t, None], moved, ahead[:, t - 1])
    for t in range(longest - 2, -1, -1):
        moved = total(pairs[None, :-1] + (scores[:, t + 1] + behind[:, t + 1])[:, None], 2)
        behind[:, t] = np.where(inside[:, t + 1, None], moved, 0)
    whole = total(ahead[:, -1], 1)[:, None, None]
    each = np.exp(ahead + behind - whole) * inside[:, :, None]
    counts = np.zeros_like(pairs)
    counts[-1] = each[:, 0].sum(axis=0)
    for t in range(1, longest):
        both = (ahead[:, t - 1, :, None] + pairs[None, :-1] + (scores[:, t] + behind[:, t])[:, None]) - whole
        counts[:-1] += (np.exp(both) * inside[:, t, None, None]).sum(axis=0)
    return each, counts


def _tag(word: Word, spans: list[Span]) -> str:
    end = word.start + len(word.text)
    for kind, a, b in spans:
        if word.start < b and a < end:
            return f"{'B' if word.start <= a else 'I'}-{kind}"
    return "O"


def field_spans(texts: list[str], field: Field) -> list[list[Span]]:
    """Spans that the field finds in each text: tagged words without the marks around them."""
    places, sequences = [], []
    for k, text in enumerate(texts):
        for words in _words(text):
            for a, b in runs(words):
                places.append((k, words[a:b]))
                sequences.append(field.scores([features(words, i) for i in range(a, b)]))
    out: list[list[Span]] = [[] for _ in texts]
    for (k, words), tags in zip(places, field.decode(sequences)):
        i = 0
        while i < len(words):
            kind, j = TAGS[tags[i]][2:], i + 1
            while kind and j < len(words) and TAGS[tags[j]] == f"I-{kind}":
                j += 1
            if kind:
                first, last = words[i], words[j - 1]
                start = first.start + len(first.text) - len(first.text.lstrip(_OUTER))
                end = last.start + len(last.text.rstrip(_OUTER))
                if kind != "card" or _is_card(texts[k][start:end]):
                    out[k].append((kind, start, end))
            i = j
    return out


def _is_card(text: str) -> bool:
    digits = "".join(c for c in text if c.isascii() and c.isdigit())
    return 13 <= len(digits) <= 19 and luhn(digits)


def all_spans(base: list[Span], added: list[Span]) -> list[Span]:
    """The patterns' spans and those of the field that touch none of them, in order of kind and place."""
    taken = sorted((a, b) for _, a, b in base)
    free = [s for s in added if not any(a < s[2] and s[1] < b for a, b in taken)]
    return sorted([*base, *free], key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def written_spans(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def _found(part: pa.RecordBatch, text: str, field: Field) -> Iterator[tuple[str, list[Span], list[Span]]]:
    texts = [t or "" for t in part.column(text).to_pylist()]
    for value, added in zip(texts, field_spans(texts, field)):
        base = base_spans(value)
        yield value, base, all_spans(base, added)


def find(docs: DataFrame, field: Field, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base, spans) per row: the patterns' counts and spans, and all spans."""
    names = [key, *(f"n_{kind}" for kind in KINDS), "base", "spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                rows = [([sum(s[0] == kind for s in base) for kind in KINDS], written_spans(base), written_spans(spans))
                        for _, base, spans in _found(part, text, field)]
                counts = [pa.array(c, pa.int64()) for c in zip(*(row[0] for row in rows))]
                told = [pa.array([row[i] for row in rows], pa.string()) for i in (1, 2)]
                yield pa.RecordBatch.from_arrays([part.column(key), *counts, *told], names)

    schema = T.StructType([docs.schema[key], *(T.StructField(n, T.LongType()) for n in names[1:5]),
                           T.StructField("base", T.StringType()), T.StructField("spans", T.StringType())])
    return docs.select(key, text).mapInArrow(run, schema)


def redact(docs: DataFrame, field: Field, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The rows with each span replaced by its kind in brackets, overlapping spans as one; null texts stay null.

    ``length`` names a column that counts the text's characters and is brought up to date.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                given = part.column(text).to_pylist()
                made = [None if old is None else _without(value, spans)
                        for old, (value, _, spans) in zip(given, _found(part, text, field))]
                at = part.schema.get_field_index(text)
                yield part.set_column(at, part.schema.field(at), pa.array(made, part.schema.field(at).type))

    out = docs.mapInArrow(run, docs.schema)
    if length in docs.columns:
        out = out.withColumn(length, F.length(text).cast(docs.schema[length].dataType))
    return out.select(*docs.columns)


def _without(text: str, spans: list[Span]) -> str:
    out, end = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= end:
            out += [text[end:a], f"[{kind.upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


# ---- the labelled table

#: Sentences to fill: braces hold a kind of value, and what follows the colon is its label. Values without a label
#: are no personal data.
TEMPLATES = (
    "call me on {national:phone} tomorrow", "tel {national:phone}", "phone: {national:phone}.",
    "fax {grouped:phone} or mobile {national:phone}", "reach the office, {bracketed:phone}, any day",
    "the number is {bracketed:phone}", "dial {international:phone} now", "Telephone {international:phone}",
    "und dann {bracketed:phone} oder {national:phone}", "the line {international:phone} is free",
    "card {card:card} expires soon", "visa {card:card}", "paid with {card:card} yesterday", "the {card:card} of it",
    "card number {short_card:card} was used", "amex {short_card:card}.",
    "from host {ip:ip} at night", "server {ip:ip}:", "the address {ip:ip} was seen", "und {ip:ip} ist da",
    "{international:phone} {card:card}", "{bracketed:phone} {card:card} und", "ha {card:card} {international:phone} de",
    "{mail:email} {international:phone}", "{ip:ip} {card:card} la", "{international:phone} {ip:ip}", "{mail:email} {ip:ip}",
    "{card:card} {mail:email}", "{international:phone} {international:phone}", "{card:card} {card:card}",
    "write to {mail:email} please", "mail <{mail:email}>", "e-mail: {mail:email}.", "que {mail:email} de",
    "mail {odd_mail:email} today", "contact {odd_mail:email}", "e-mail {odd_mail:email}.",
    "under the License, version {version}.", "CC BY-NC {version}", "section {version} of page {small}",
    "in the year {year} there were {small} of them", "from {year} to {year}, {small} and {small}",
    "a price of {price} for {small} pieces", "it took {small} minutes, {price} in all", "on {date} and {date}",
    "at {time} the {small}th of the month", "token = \"{hex}\" there", "password={hex}", "key {key} was lost",
    "the {number} of it", "und {number} de", "{number}", "{number} {ip:ip}", "{number} {card:card}", "{card:card} {number} la",
    "card {number} has a wrong digit", "number {number}.", "{grouped_number} {international:phone}", "of {grouped_number} on",
    "the id {long_id} of the order {order}", "order {order} has {small} parts", "see {small}-{small} and {version}",
    "the table: {small} {small} {small} {year} {price}", "in {year}, chapter {small}, {version}", "@ {small} each",
    "user @{name} said {small}", "@{name} and @{name}", "width {small}x{small}", "no {long_id}", "ratio {price}%",
)


def _value(kind: str, rng) -> str:
    d = lambda n: "".join(str(x) for x in rng.integers(0, 10, n))
    letters = lambda n: "".join(chr(97 + x) for x in rng.integers(0, 26, n))
    one = lambda *options: options[rng.integers(len(options))]

    def checked(n, valid=True):
        """Digits that pass the Luhn check, or that miss it by their last."""
        head = d(n - 1)
        last = next(x for x in "0123456789" if luhn(head + x))
        return head + (last if valid else str((int(last) + int(rng.integers(1, 10))) % 10))

    four = lambda digits, sign: sign.join(digits[k:k + 4] for k in range(0, len(digits), 4))
    return {
        "national": lambda: f"{d(3)}{(s := one('-', '.', ' '))}{d(3)}{s}{d(4)}",
        "grouped": lambda: f"0{d(3)} {d(3)} {d(3)}", "bracketed": lambda: f"({d(3)}) {d(3)}-{d(4)}",
        "international": lambda: one(f"+{d(1)} ({d(3)}) {d(3)}-{d(4)}", f"+{d(2)} {d(3)} {d(7)}", f"+{d(2)}-{d(3)}-{d(6)}"),
        "card": lambda: one(c := checked(16), four(c, " "), four(c, "-")),
        "short_card": lambda: f"{(c := checked(15))[:4]} {c[4:10]} {c[10:]}",
        "number": lambda: checked(16, False), "grouped_number": lambda: four(checked(16, False), one(" ", "-")), "ip": lambda: ".".join(str(x) for x in rng.integers(1, 255, 4)),
        "mail": lambda: f"{letters(6)}.{d(2)}@{letters(5)}{one('', d(1))}.example.{one('com', 'org', 'net')}",
        "odd_mail": lambda: f"{letters(5)}@[{letters(6)}.{one('com', 'org')}]", "name": lambda: letters(7),
        "version": lambda: f"{d(1)}.{d(1)}", "small": lambda: str(rng.integers(1, 999)), "year": lambda: f"19{d(2)}",
        "price": lambda: f"{rng.integers(1, 9999)}.{d(2)}", "date": lambda: f"{d(2)}/{d(2)}/{d(4)}",
        "time": lambda: f"{d(2)}:{d(2)}", "hex": lambda: "".join(f"{x:x}" for x in rng.integers(0, 16, one(18, 40))),
        "key": lambda: f"AKIA{''.join(one(*'ABCDEFGHJKLMNPQRSTUVWXYZ234567') for _ in range(16))}",
        "long_id": lambda: d(one(9, 12, 22)), "order": lambda: f"{one('A', 'PO', 'X')}-{d(6)}",
    }[kind]()


def labelled_rows(copies: int = 12, seed: int = 7) -> list[tuple[str, list[Span]]]:
    """The labelled table: every template filled ``copies`` times."""
    rng, rows = np.random.default_rng(seed), []
    for template in TEMPLATES * copies:
        text, spans = "", []
        for part in re.split(r"(\{[^}]*\})", template):
            if part[:1] != "{":
                text += part
                continue
            kind, _, label = part[1:-1].partition(":")
            value = _value(kind, rng)
            if label:
                spans.append((label, len(text), len(text) + len(value)))
            text += value
        rows.append((text, spans))
    return rows


def labelled_table(spark: SparkSession, copies: int = 12) -> DataFrame:
    """(text, spans) rows to train from, spans as ``kind:start:end`` joined by commas; a user's own table looks the same."""
    return spark.createDataFrame([(t, written_spans(s)) for t, s in labelled_rows(copies)], "text string, spans string")


def train_table(labelled: DataFrame, most: int = 20_000) -> Field:
    """The field of a labelled table, which must be small: at most ``most`` rows; null texts or spans are none."""
    rows = labelled.select("text", "spans").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the labelled table has more than {most} rows")
    return train([(r.text or "", [(k, int(a), int(b)) for k, a, b in (s.split(":") for s in (r.spans or "").split(",") if s)])
                  for r in rows])

