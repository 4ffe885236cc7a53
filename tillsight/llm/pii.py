"""Personal data: exact patterns, and a conditional random field for what they miss.

The patterns find e-mail and IP addresses, card and phone numbers. The field is
a linear chain over the words of a text: the features of a word are its shape
and those of its neighbours, labels say where a span of which kind begins and
goes on. It is fitted on a small labelled table below and decoded by Viterbi,
many stretches of text at a time. Its spans are added where no pattern matched.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillsight.llm.texts import boxed, pieces, text_buffer, unboxed, word_spans

KINDS = ("email", "ip", "card", "phone")
LABELS = ["O", *(f"{mark}-{kind}" for kind in KINDS for mark in "BI")]

# Labelled examples: spans in braces; each 0 stands for a digit and each ~ for a letter, drawn anew
# for every copy of an example.
EXAMPLES = """
please call {phone:+0 (000) 000-0000} after lunch
my number is {phone:+00 00 0000 0000} and hers is {phone:+0-000-000-0000}
call {phone:(000) 000-0000} or write to {email:~~~~.00@~~~~0.~~~~.com}
tel {phone:(000) 000-0000}, ask for the manager
tel. {phone:000-000-0000} in the morning
phone {phone:000-000-0000} or {phone:000.000.0000} at night
mobile {phone:000 000 0000} was noted
the office answers {phone:00 00 00 00 00} all day
fax {phone:0 (000) 000-0000} is out of use
reach us under {phone:0000 000 0000} or {email:~~~~~@~~~~.org}
send it to {email:~~~~~~.~~@~~~~.example.com} today
write {email:~~~~~@~~~~~} and wait
mail {email:~~~~ (at) ~~~~~.com} for help
contact {email:~~~~.~~ [at] ~~~~~.org}, please
{email:~~~~(at)~~~~.net} was her address
the host {ip:00.000.00.000} did not answer
from {ip:000.00.0.00}, then from {ip:00.00.000.0}
block {ip:000[.]00[.]00[.]000} at once
card {card:0000000000000000} was charged
paid with {card:0000 0000 0000 0000} on monday
paid with {card:0000-0000-0000-0000}, thanks
number {card:0000.0000.0000.0000} on the slip
in 0000 there were 000 of them
it happened on 0000-00-00 at 00:00
on 00.00.0000 the price was 00,00 or 00.00
version 0.0 and version 0.0.0 of the public license
see pages 000-000 and chapter 00
they sold 0,000,000 pieces for 000000 in all
the key is 0~00~~0~~~000~0~~ and the rest is noise
password=0~00~~0~~~000~0~~ was in the file
order 00000000 of article 000-00 left the house
about 00% of 000 people, or 00 in 000
room 00, floor 0, building 000
a line of words with no numbers at all in it
he said 00 and she said 00 and they said 00
row 000 000 000 of the table
| 00 | 000 | 0000 | 00 |
at 00:00:00 the counter stood at 000000000000
invoice no. 0000/00 from 0000
licensed under ~~ ~~ 0.0 or later
""".strip().splitlines()
# Frames with a place for a span of each kind, and forms that fill it, drawn anew for every copy of a frame.
FRAMES = """
call me: {phone}
call me under {phone} before noon
you can ring {phone} or text {phone}
her number is {phone}, not {phone}
contact: {phone} / {email}
whatsapp {phone} only
dial {phone} and ask for room 000
tel: {phone}
phone={phone}
telephone number {phone}.
the hotline {phone} is open from 0 to 00
please text {phone} today
reach me at {phone} or at {email}
you can reach our desk on {phone}
name, street 00, {phone}, {email}
fax: {phone} mail: {email}
his cell is {phone} I think
write to {email} or {email}
mail me: {email}
email {email} for the file
e-mail: {email}
my address is {email}, thanks
send 00 copies to {email} please
ask {email} about version 0.0
questions go to {email}.
contact {email} today
login from {ip} at 00:00
ip: {ip}
the server {ip} and the server {ip}
blocked address {ip} for 00 days
connect to {ip} on port 0000
ping {ip} failed
my card is {card} and expires 00/00
card number: {card}
visa {card} was charged 00.00
charge it to {card}, please
credit card {card} code 000
pay by {card} or call {phone}
""".strip().splitlines()
FORMS = {
    "phone": """
000-0000
0000000000
000 0000
(000) 000-0000
(000)000-0000
(000) 000 0000
000-000-0000
000.000.0000
000 000 0000
000/000-0000
0-000-000-0000
0 000 000 0000
000 0000 0000
0000 000 0000
00000 000000
0000-000-000
0000/000000
00000/00000
00 00 00 00 00
00.00.00.00.00
00-00-00-00-00
0000-0000
00 0000 0000
+0 (000) 000-0000
+00 00 0000 0000
(0000) 000000
(00) 0000-0000
""".strip().splitlines(),
    "email": """
~~~~~ (at) ~~~~.com
~~~ (at) ~~~~~~ (dot) org
~~~~(at)~~~~.net
~~~~~[at]~~~~[dot]com
~~~~~ [at] ~~~~~ [dot] com
~~~~~ {at} ~~~~~ {dot} com
~~~ at ~~~~ dot com
~~~~~ AT ~~~~~ DOT org
~~~~~.~~~ at ~~~~~ dot net
~~~00 at ~~~~ dot com
~~~~~ @ ~~~~.com
~~~~.~~@ ~~~~~.org
~~~~~@~~~~~
~~~~~@~~~~ dot com
~~~~.00@~~~~0.~~~~.com
~~~~~@~~~~.org
""".strip().splitlines(),
    "ip": """
00.00.000.0
000.000.0.00
00[.]00[.]000[.]0
000[.]00.0.00
00(.)000(.)00(.)0
000 . 00 . 0 . 000
0-00-000-00
000,000,00,0
""".strip().splitlines(),
    "card": """
0000000000000000
0000 0000 0000 0000
0000-0000-0000-0000
0000.0000.0000.0000
0000/0000/0000/0000
0000 000000 00000
0000-000000-00000
0000_0000_0000_0000
000000000000000
0000  0000  0000  0000
""".strip().splitlines(),
}
# Words with digits, at signs or dots that are no personal data.
LOOKALIKES = """
see you at 00:00 or at 00
meet at noon, the dot on the map
look at the red dot near 00
the dot in line 000 at the end
from 0000 to 0000 and 0000 to 0000
pages 000-000, 000-000 and 0000
00 0000 0000 0000 of them in 0000
isbn 000-0-0000-0000-0
serial 0000-~~~~-0000-~~~~ was lost
order 0000000000 has left
article 000-0000 is sold out
invoice 0000000 of 00.00.0000
the total is 0000000.00 of 00000000
hash ~0~00~0~00~~00~0 of file 00
id 0000000000000 in table 0
population 0,000,000 in 0000
numbers 00 00 00 00 were drawn
rows 0000 0000 0000 of the sheet
0 0 0 0 0 and 00 00
on 0000/00/00 at 00:00:00.000
0000-00-00T00:00:00 done
version 0.0.0.0-~~ came out
section 0.0.0.0 of the law
chapter 0.0 and chapter 0.0.0
ratio 00/00 or 000/000
the code 000000 is valid for 00 minutes
temperature -00.0 to 00.0
scores 0-0, 0-0 and 00-00
room 000-0 on floor 0
price 000.00 - 000.00 each
latitude 00.000000, longitude 00.000000
timestamp 0000000000 in the log
we paid 0000000 in 0000
size 0000x0000 pixels
@~~~~~ said so
follow @~~~~00 and @~~~~~
3 @ 0.00 each
apache license, version 0.0
under cc by 0.0.
""".strip().splitlines()
COPIES = 6
#: Share of words outside spans that are replaced by letters in filled frames, so that spans do not
#: hang on a cue, and how often a feature occurs in the table at least.
REPLACED = 0.3
LEAST_SEEN = 3
#: Words on each side of a word with a digit or an at sign that the field looks at.
CONTEXT = 3

_SPELT_AT = re.compile(r"\A[\[({]?at[\])}]?\Z", re.IGNORECASE)
_SPELT_DOT = re.compile(r"\A[\[({]?dot[\])}]?\Z", re.IGNORECASE)
_AT = re.compile(r"@|[\[({]at[\])}]", re.IGNORECASE)
_ADDRESS = re.compile(r"\S\s*(?:@|[\[({]at[\])}]|\sat\s)\s*\S", re.IGNORECASE)
_EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_EMAIL_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]")
_LOCAL_CHARACTERS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def passes_luhn(digits: str) -> bool:
    doubled = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[::-2])) + sum(n - 9 * (n > 9) for n in doubled)) % 10 == 0


def _emails(text: str):
    """Each at sign with the longest address around it; an address cannot begin in the one before."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARACTERS:
            start -= 1
        domain = _EMAIL_DOMAIN.match(text, at) if start < at else None
        if domain:
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of all pattern matches, in that order."""
    spans = [(start, 0, end) for start, end in _emails(text)] if "@" in text else []
    for found in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in found[0].split(".")):
            spans.append((found.start(), 1, found.end()))
    for found in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", found[0])
        if 12 <= len(digits) <= 19 and passes_luhn(digits):
            spans.append((found.start(), 2, found.end()))
    if "+" in text:
        for found in _PHONE.finditer(text):
            if 9 <= len(_NO_DIGIT.sub("", found[0])) <= 15:
                spans.append((found.start(), 3, found.end()))
    return sorted(spans)


#: Longer words are looked at each time, so that what is remembered has a bound.
_REMEMBERED = 256
#: Words up to this length may be cues, as ``call``; the field knows those of its table.
_CUE_LENGTH = 12


@lru_cache(maxsize=100_000)
def word_features(word: str) -> tuple[str, ...]:
    """What the field sees of a word: the shape of all of it, in two degrees of detail."""
    shape = re.sub(r"[0-9]", "0", re.sub(r"[^\W\d_]", "x", word))
    runs = re.sub(r"x+", "x", re.sub(r"0+", "0", shape))
    digits = shape.count("0")
    if _SPELT_AT.match(word) or _SPELT_DOT.match(word):
        lower = word.lower()
        return (f"spelt={lower.strip('[({])}')}", f"boxed={lower[0] in '[({'}")
    if not digits and not _AT.search(word):
        own = ("plain", f"ends={word[-1:] if word[-1:] in ':=,.;!?' else ''}", f"dots={'.' in word.strip('.')}")
        return (*own, f"word={word.lower().strip(',;:!?.=')}") if len(word) <= _CUE_LENGTH else own
    lengths = "-".join(str(min(len(run), 6)) for run in re.findall(r"0+", shape))
    return (
        f"runs={runs.strip(',;:!?')}", f"lengths={lengths}", f"digits={min(digits, 17)}",
        f"first={shape[:1]}", f"at={bool(_AT.search(word))}", f"letters={'x' in shape}",
        f"groups={min(runs.count('0'), 6)} of {min(digits, 17)}", f"marks={''.join(sorted(set(re.sub('[x0]', '', runs.strip(',;:!?')))))[:4]}",
    )


def _sequence_features(words: list[str]) -> list[list[str]]:
    own = [(word_features if len(word) <= _REMEMBERED else word_features.__wrapped__)(word) for word in words]
    edge = ("edge",)
    return [
        [
            *(f"0 {f}" for f in own[i]),
            *(f"-1 {f}" for f in (own[i - 1] if i else edge)),
            *(f"+1 {f}" for f in (own[i + 1] if i + 1 < len(own) else edge)),
            *(f"-2 {f}" for f in (own[i - 2] if i > 1 else edge)),
            *(f"+2 {f}" for f in (own[i + 2] if i + 2 < len(own) else edge)),
        ]
        for i in range(len(own))
    ]


def labelled_rows(examples: list[str], seed: int) -> list[tuple[list[str], list[int]]]:
    """Words and label numbers of examples with spans in braces."""
    random = np.random.default_rng(seed)

    def drawn(text: str) -> str:
        text = re.sub("0", lambda _: str(random.integers(10)), text)
        return re.sub("~", lambda _: chr(97 + random.integers(26)), text)

    rows = []
    for example in examples:
        words, labels = [], []
        for part in re.split(r"(\S*\{(?:email|ip|card|phone):(?:[^{}]|\{\w+\})*\}\S*)", example):
            marked = re.match(r"(\S*)\{(\w+):((?:[^{}]|\{\w+\})*)\}(\S*)", part)
            inside = drawn(marked[1] + marked[3] + marked[4] if marked else part).split()
            for place, word in enumerate(inside):
                words.append(word)
                labels.append(LABELS.index(f"{'I' if place else 'B'}-{marked[2]}") if marked else 0)
        rows.append((words, labels))
    return rows


def filled(frames: list[str], forms: dict[str, list[str]], seed: int) -> list[str]:
    """Examples from frames: each place gets a form of its kind, and some other words are replaced."""
    random = np.random.default_rng(seed)
    of_kind = "|".join(KINDS)

    def word(plain: re.Match) -> str:
        return "~" * len(plain[0]) if random.random() < REPLACED else plain[0]

    def form(place: re.Match) -> str:
        return f"{{{place[1]}:{forms[place[1]][random.integers(len(forms[place[1]]))]}}}"

    frames = [re.sub(r"(?<!\S)[a-z]+(?!\S)", word, frame) for frame in frames]
    return [re.sub(rf"\{{({of_kind})\}}", form, frame) for frame in frames]


def labelled_table(copies: int = COPIES, seed: int = 11) -> list[tuple[list[str], list[int]]]:
    """Words and label numbers of the examples, filled frames and look-alikes."""
    examples = EXAMPLES * copies + filled(FRAMES * 3 * copies, FORMS, seed) + LOOKALIKES * copies
    return labelled_rows(examples, seed)


class ChainField:
    """A linear-chain conditional random field."""

    def __init__(self, features: dict[str, int], weights: np.ndarray, moves: np.ndarray):
        self.features, self.weights, self.moves = features, weights, moves

    @classmethod
    def fit(cls, rows, steps: int = 120, rate: float = 0.1, penalty: float = 0.02) -> ChainField:
        """Maximum likelihood with a quadratic penalty, by Adam over the whole table."""
        seen = [_sequence_features(words) for words, _ in rows]
        often = Counter(f for sequence in seen for fs in sequence for f in fs)
        number = {f: i for i, f in enumerate(f for f, times in often.items() if times >= LEAST_SEEN)}
        coded = [[[number[f] for f in fs if f in number] for fs in sequence] for sequence in seen]
        count, size = len(rows), max(len(words) for words, _ in rows)
        inputs = np.zeros((count, size, len(number)), dtype=np.float32)
        gold = np.zeros((count, size, len(LABELS)))
        alive = np.zeros((count, size), dtype=bool)
        for i, (sequence, (_, labels)) in enumerate(zip(coded, rows)):
            for t, (found, label) in enumerate(zip(sequence, labels)):
                inputs[i, t, found] = 1
                gold[i, t, label] = 1
                alive[i, t] = True
        flat = inputs[alive]
        pairs = np.einsum("ita,itb->ab", gold[:, :-1], gold[:, 1:])
        field = cls(number, np.zeros((len(number), len(LABELS))), np.zeros((len(LABELS),) * 2))
        state = [np.zeros_like(x) for x in (field.weights, field.weights, field.moves, field.moves)]
        for step in range(1, steps + 1):
            scores = np.zeros((count, size, len(LABELS)))
            scores[alive] = flat @ field.weights.astype(np.float32)
            one, two = field._expected(scores, alive)
            slopes = (
                flat.T @ (one - gold)[alive].astype(np.float32) / count + penalty / count * field.weights,
                (two - pairs) / count + penalty / count * field.moves,
            )
            for target, slope, mean, square in zip(
                (field.weights, field.moves), slopes, state[::2], state[1::2]
            ):
                mean += 0.1 * (slope - mean)
                square += 0.01 * (slope**2 - square)
                target -= rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        return field

    def _expected(self, scores: np.ndarray, alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Expected labels and pairs of labels by the forward-backward recursions."""
        count, size, labels = scores.shape
        ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
        ahead[:, 0] = scores[:, 0]
        for t in range(1, size):
            moved = _log_sum(ahead[:, t - 1, :, None] + self.moves, 1) + scores[:, t]
            ahead[:, t] = np.where(alive[:, t, None], moved, ahead[:, t - 1])
        for t in range(size - 2, -1, -1):
            moved = _log_sum(self.moves + (scores[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
            behind[:, t] = np.where(alive[:, t + 1, None], moved, 0)
        total = _log_sum(ahead[:, -1], 1)[:, None]
        one = np.exp(ahead + behind - total[:, None]) * alive[..., None]
        two = np.zeros((labels, labels))
        for t in range(1, size):
            joint = ahead[:, t - 1, :, None] + self.moves + (scores[:, t] + behind[:, t])[:, None, :]
            two += np.einsum("iab,i->ab", np.exp(joint - total[..., None]), alive[:, t].astype(float))
        return one, two

    def decode(self, sequences: list[list[str]]) -> list[np.ndarray]:
        """The likeliest labels of each sequence of words, those of one length together."""
        labels: list = [None] * len(sequences)
        by_length: dict[int, list[int]] = {}
        for at, words in enumerate(sequences):
            by_length.setdefault(len(words), []).append(at)
        for size, members in by_length.items():
            for low in range(0, len(members), max(1, 20_000 // size)):
                group = members[low : low + max(1, 20_000 // size)]
                found = self._viterbi(np.stack([self._scores(sequences[i]) for i in group]))
                for i, path in zip(group, found):
                    labels[i] = path
        return labels

    def _scores(self, words: list[str]) -> np.ndarray:
        known, scores = self.features, np.zeros((len(words), len(LABELS)))
        for t, found in enumerate(_sequence_features(words)):
            rows = [known[f] for f in found if f in known]
            scores[t] = self.weights[rows].sum(axis=0)
        return scores

    def _viterbi(self, scores: np.ndarray) -> np.ndarray:
        count, size, _ = scores.shape
        came = np.zeros(scores.shape, dtype=np.int8)
        best = scores[:, 0]
        for t in range(1, size):
            ways = best[:, :, None] + self.moves
            came[:, t] = ways.argmax(axis=1)
            best = ways.max(axis=1) + scores[:, t]
        path = np.zeros((count, size), dtype=np.int8)
        path[:, -1] = best.argmax(axis=1)
        for t in range(size - 1, 0, -1):
            path[:, t - 1] = came[np.arange(count), t, path[:, t]]
        return path


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.log(np.exp(values - top).sum(axis=axis)) + np.squeeze(top, axis)


_CANDIDATE = np.zeros(256, dtype=bool)
_CANDIDATE[[*range(ord("0"), ord("9") + 1), ord("@")]] = True
_WRITTEN_OUT = re.compile(rb"[\[({]at[\])}]|\bdot\b", re.IGNORECASE)


def _stretches(data: np.ndarray, starts: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
    """Runs of words around those that may be personal data, none over the end of a text.

    All other words are outside any span: the field has no label but ``O`` for
    them, as they have neither digit nor at sign nor a written-out dot in reach.
    """
    marks = np.flatnonzero(_CANDIDATE[data])
    written_out = [m.start() for m in _WRITTEN_OUT.finditer(data)]
    marks = np.concatenate([marks, np.array(written_out, dtype=np.int64)])
    if not len(marks) or not len(starts):
        return []
    words = np.unique(np.searchsorted(starts, marks, side="right") - 1)
    text = np.searchsorted(first, words, side="right") - 1
    lows = np.maximum(words - CONTEXT, first[text])
    highs = np.minimum(words + CONTEXT + 1, first[text + 1])
    opens = np.concatenate([[True], (lows[1:] > highs[:-1]) | (text[1:] != text[:-1])])
    closes = np.append(np.flatnonzero(opens)[1:] - 1, len(words) - 1)
    return list(zip(lows[opens].tolist(), highs[closes].tolist()))


def _plausible(kind: str, text: str) -> bool:
    """What a span of the field must have to be believed."""
    digits = _NO_DIGIT.sub("", text)
    if kind == "email":
        return bool(_ADDRESS.search(text))
    if kind == "ip":
        parts = re.findall(r"[0-9]+", text)
        return len(parts) == 4 and all(len(part) <= 3 and int(part) <= 255 for part in parts)
    if kind == "card":
        return 12 <= len(digits) <= 19 and passes_luhn(digits)
    return 7 <= len(digits) <= 15 and (text[0] in "(+0123456789")


class Finder:
    """Finds spans in batches of texts."""

    def __init__(self, field: ChainField):
        self.field = field

    def spans(self, column: pa.Array) -> list[tuple[list, list]]:
        """Base spans and all spans of each text, as (start, number of the kind, end)."""
        texts = [text or "" for text in column.to_pylist()]
        base = [base_spans(text) for text in texts]
        every = [list(found) for found in base]
        for row, start, kind, end in self._added(column, base):
            every[row].append((start, kind, end))
        return [(b, sorted(e)) for b, e in zip(base, every)]

    def _added(self, column: pa.Array, base: list):
        data, bounds = text_buffer(column)
        starts, ends, first = word_spans(data, bounds)
        stretches = _stretches(data, starts, first)
        if not stretches:
            return
        word = lambda i: data[starts[i] : ends[i]].tobytes().decode()
        sequences = [[word(i) for i in range(low, high)] for low, high in stretches]
        points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        for (low, _), words, path in zip(stretches, sequences, self.field.decode(sequences)):
            row = int(np.searchsorted(bounds, starts[low], side="right")) - 1
            for begin, stop, kind in _labelled_spans(path):
                start, end = starts[low + begin], ends[low + stop - 1]
                text = data[start:end].tobytes().decode()
                trimmed = text.lstrip(",;:!?\"'").rstrip(",;:!?\"'.")
                if trimmed.endswith(")") and "(" not in trimmed:
                    trimmed = trimmed[:-1]
                if not trimmed or not _plausible(KINDS[kind], trimmed):
                    continue
                at = points[start] - points[bounds[row]] + text.index(trimmed)
                span = int(at), kind, int(at) + len(trimmed)
                if all(span[2] <= other[0] or other[2] <= span[0] for other in base[row]):
                    yield row, *span


def _labelled_spans(path: np.ndarray):
    """(first word, end, kind) of each run of B and I labels of one kind."""
    at = 0
    while at < len(path):
        label = int(path[at])
        if label == 0:
            at += 1
            continue
        kind, end = (label - 1) // 2, at + 1
        while end < len(path) and path[end] == 2 * kind + 2:
            end += 1
        yield at, end, kind
        at = end


def _written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


_fitted: list[ChainField] = []


def fitted_field() -> ChainField:
    """The field fitted on the labelled table, once a process."""
    if not _fitted:
        _fitted.append(ChainField.fit(labelled_table()))
    return _fitted[0]


def find_personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: ``base_spans`` and ``spans``, as text, and the number of base spans by kind.

    A null text is empty and has no spans. Rows that share an id are read one by one.
    """
    field = docs.sparkSession.sparkContext.broadcast(fitted_field())

    def run(batches):
        finder = Finder(field.value)
        for piece in pieces(batches, limit=2 << 20):
            found = finder.spans(piece.column("text"))
            counts = [[sum(kind == k for _, kind, _ in base) for base, _ in found] for k in range(len(KINDS))]
            yield pa.record_batch(
                [piece.column("doc_id"), *(pa.array(x, pa.int64()) for x in counts),
                 pa.array([_written(base) for base, _ in found], pa.string()),
                 pa.array([_written(every) for _, every in found], pa.string())],
                names=["doc_id", *(f"n_{kind}" for kind in KINDS), "base_spans", "spans"],
            )

    counts = ", ".join(f"n_{kind} bigint" for kind in KINDS)
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(run, f"doc_id bigint, {counts}, base_spans string, spans string")


def mask_personal_data(docs: DataFrame) -> DataFrame:
    """``docs`` with every span replaced by its kind in angle brackets; all else is unchanged.

    Null and empty texts stay as they are, and each of repeated rows is masked by itself.
    """
    field = docs.sparkSession.sparkContext.broadcast(fitted_field())

    def run(batches):
        finder = Finder(field.value)
        for piece in pieces(batches, limit=2 << 20):
            column = piece.column("text")
            texts = [
                None if text is None else _masked(text, every)
                for text, (_, every) in zip(column.to_pylist(), finder.spans(column))
            ]
            yield pa.record_batch([piece.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    rows = boxed(docs.withColumn("text", F.col("text").cast("string")))
    return unboxed(rows.mapInArrow(run, rows.schema), docs.columns)


def _masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """Overlapping spans become one mask, of the first one's kind."""
    parts, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            parts += [text[at:start], f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def personal_data_digest(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, base spans by kind, their hash, and all spans.

    Nulls, empty texts and repeated rows as in ``find_personal_data``.
    """
    found = find_personal_data(docs)
    return found.select(
        "doc_id", *[f"n_{kind}" for kind in KINDS],
        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans",
    )
