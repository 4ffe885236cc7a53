"""Byte-level BPE by a finite-state transducer, and streaming decoding.

A token sequence is what the merges make of its bytes exactly if the merges
leave every two neighbours apart. So the merges compile into a transducer: it
walks the trie of tokens, and where a token ends it may start the next one if
the two are such neighbours. Read byte by byte there are several open walks but
only one of them ends at each byte. The transducer is determinised as texts are
read: a state is the set of trie nodes in which walks are open, and a step
tells which tokens may end. The one that does is the one whose left neighbour
stays apart from it; what ended at each byte is a register beside the state,
not part of it, so there are few states. Tokens that all open walks have
behind them are emitted.
"""

from __future__ import annotations

import base64
import hashlib
import sys
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillsight.llm.texts import boxed, pieces, unboxed, word_hashes

#: Pairs of neighbours that a worker remembers before it starts afresh.
MEMORY = 1_000_000
#: Bytes of a piece after which settled tokens are taken out of the register.
_SETTLE_BYTES = 4096
#: Pieces up to this many bytes are walked together, longer ones singly.
_TOGETHER_BYTES = 256
_BATCH_BYTES = 2 << 20

#: Fixed value: the pattern that the array splitter below stands for.
GPT2_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def parse_ranks(lines: bytes) -> dict[bytes, int]:
    """Tokens and ranks from a file of lines of base64 token and rank."""
    pairs = (line.split() for line in lines.splitlines() if line.strip())
    return {base64.b64decode(token): int(rank) for token, rank in pairs}


class _Pairs:
    """Answers of ``make`` for pairs of tokens, in a hash table of arrays that is asked for many at once."""

    def __init__(self, memory: int, make):
        self._make, self._bits = make, max(6, (2 * memory - 1).bit_length())
        self._forget()

    def _forget(self) -> None:
        self._keys = np.full(1 << self._bits, -1, dtype=np.int64)
        self._values = np.zeros(1 << self._bits, dtype=bool)
        self._used = 0

    def _slots(self, pairs: np.ndarray) -> np.ndarray:
        spread = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self._bits)).astype(np.int64)

    def _places(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The slot of each pair, or the empty one where it belongs, and what is there."""
        at, last = self._slots(pairs), (1 << self._bits) - 1
        found = self._keys[at]
        while len(others := np.flatnonzero((found != pairs) & (found >= 0))):
            at[others] = (at[others] + 1) & last
            found[others] = self._keys[at[others]]
        return at, found

    def __call__(self, pairs: np.ndarray) -> np.ndarray:
        at, found = self._places(pairs)
        if (found >= 0).all():
            return self._values[at]
        new = np.unique(pairs[found < 0])
        answers = np.array([self._make(pair) for pair in new.tolist()], dtype=bool)
        if self._used + len(new) > len(self._keys) // 2:
            self._forget()
        if len(new) > len(self._keys) // 2:  # more than are remembered
            result = self._values[at]
            unknown = found < 0
            result[unknown] = answers[np.searchsorted(new, pairs[unknown])]
            known = self._keys[at[~unknown]] == pairs[~unknown]
            return result if known.all() else np.array([self._make(pair) for pair in pairs.tolist()], dtype=bool)
        for slot, pair, answer in zip(self._slots(new).tolist(), new.tolist(), answers.tolist()):
            while self._keys[slot] >= 0:
                slot = slot + 1 & len(self._keys) - 1
            self._keys[slot], self._values[slot] = pair, answer
        self._used += len(new)
        return self(pairs)


class _State(dict):
    """Steps by byte, each made when it is first taken; ``nodes`` are the open walks but the new one."""

    __slots__ = ("nodes", "number", "_make")

    def __init__(self, nodes: tuple[int, ...], number: int, make):
        super().__init__()
        self.nodes, self.number, self._make = nodes, number, make

    def __missing__(self, byte: int):
        step = self[byte] = self._make(self.nodes, byte)
        return step


class Transducer:
    """Encodes single pieces; built from ranks, determinised lazily."""

    def __init__(self, ranks: dict[bytes, int], memory: int = MEMORY):
        self._ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self._lengths = np.zeros(max(ranks.values(), default=0) + 1, dtype=np.int64)
        for token, rank in ranks.items():
            self._lengths[rank] = len(token)
        self._length = self._lengths.tolist()
        self._trie: list[dict[int, int]] = [{}]
        self._token_at: list[int | None] = [None]
        self._rank_at: list[int | None] = [None]
        self._depth: list[int] = [0]
        self._halves: dict[int, tuple[int, int]] = {}
        for token, rank in ranks.items():
            if len(token) > 1:
                parts = self.merged(token, stop_at=2)
                if len(parts) == 2:
                    self._halves[rank] = parts[0], parts[1]
            node = 0
            for byte in token:
                if byte not in self._trie[node]:
                    self._trie[node][byte] = len(self._trie)
                    self._trie.append({})
                    self._token_at.append(None)
                    self._rank_at.append(None)
                    self._depth.append(self._depth[node] + 1)
                node = self._trie[node][byte]
            self._rank_at[node] = rank
            if len(token) == 1 or rank in self._halves:
                self._token_at[node] = rank
        #: Tokens that the merges never make; only a whole piece can be one.
        self._never_made = {token for token, rank in ranks.items() if len(token) > 1 and rank not in self._halves}
        self._spines: dict[int, tuple[list, dict]] = {}
        self._known: dict[int, bool] = {}
        self._memory = memory
        self._apart_all = _Pairs(memory, self._stay_apart)
        self._states: dict[tuple[int, ...], _State] = {}
        self._numbered: list[_State] = []
        self._start = self._state(())
        # The same steps as arrays: by 256 * state + byte the next state, and where its endings are listed.
        self._next = np.full(256, -1, dtype=np.int32)
        self._first = np.zeros(256, dtype=np.int64)
        self._ends = np.zeros((2, 1024), dtype=np.int64)
        self._listed = 0

    @property
    def states(self) -> int:
        """States made so far; as many as there are trie nodes at most, as the longest walk tells the others."""
        return len(self._states)

    def _state(self, nodes: tuple[int, ...]) -> _State:
        if nodes not in self._states:
            self._states[nodes] = _State(nodes, len(self._states), self._step)
            self._numbered.append(self._states[nodes])
        return self._states[nodes]

    def merged(self, data: bytes, stop_at: int = 1) -> list[int]:
        """The merges done plainly, lowest rank first; for short strings."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > stop_at:
            ranked = [
                (self._ranks[pair], i)
                for i in range(len(parts) - 1)
                if (pair := parts[i] + parts[i + 1]) in self._ranks
            ]
            if not ranked:
                break
            _, at = min(ranked)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self._ranks[part] for part in parts]

    def _spine(self, token: int) -> tuple[list, dict]:
        """What stands at the token's right and left edge while it is merged.

        At the right the trie node of each part and the rank of the merge that
        swallows it, at the left that rank by the part's length. The whole
        token is never swallowed.
        """
        if token not in self._spines:
            sides = []
            for side in (1, 0):
                part, until, edge = token, len(self._ranks) + 1, []
                while True:
                    edge.append((part, until))
                    if part not in self._halves:
                        break
                    part, until = self._halves[part][side], part
                sides.append(edge)
            right = [(self._node(self.tokens[part]), until) for part, until in sides[0]]
            self._spines[token] = right, {self._length[part]: until for part, until in sides[1]}
        return self._spines[token]

    def _node(self, data: bytes) -> int:
        node = 0
        for byte in data:
            node = self._trie[node][byte]
        return node

    def _stay_apart(self, pair: int) -> bool:
        """Whether no merge joins the two tokens of ``pair`` where they meet.

        Merges go by rank, so a merge across is made if its rank comes before
        the ranks that swallow the two parts it needs; of equal ranks the
        leftmost goes first.
        """
        trie, rank_at = self._trie, self._rank_at
        right, starts = self.tokens[pair & 0xFFFFFFFF], self._spine(pair & 0xFFFFFFFF)[1]
        for node, gone in self._spine(pair >> 32)[0]:
            for length, byte in enumerate(right, 1):
                node = trie[node].get(byte)
                if node is None:
                    break
                rank = rank_at[node]
                if rank is not None and rank < gone and rank <= starts.get(length, -1):
                    return False
        return True

    def _step(self, nodes: tuple[int, ...], byte: int) -> tuple[_State, tuple[tuple[int, int], ...]]:
        """The next state, and (length, token) of what may end here, longest first."""
        trie, token_at = self._trie, self._token_at
        reached = [child for node in (*nodes, 0) if (child := trie[node].get(byte)) is not None]
        ended = tuple((self._depth[node], token_at[node]) for node in reached if token_at[node] is not None)
        return self._state(tuple(node for node in reached if trie[node])), ended

    def encode(self, piece: bytes) -> list[int]:
        """Token ids of one piece."""
        whole = self._ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(piece) > _SETTLE_BYTES:
            return [token for tokens in self.stream(piece) for token in tokens]
        last: list[int] = []
        self._walk(piece, last, self._start)
        return self._between(last, 0, len(last) - 1)

    def _walk(self, data: bytes, last: list[int], state: _State) -> _State:
        """Reads bytes on; ``last`` is the register, the token that ends at each byte."""
        at = len(last)
        for byte in data:
            state, ended = state[byte]
            for length, token in ended:
                if length > at or self._apart(last[at - length] << 32 | token):
                    last.append(token)
                    break
            at += 1
        return state

    def _apart(self, pair: int) -> bool:
        known = self._known.get(pair)
        if known is None:
            if len(self._known) >= self._memory:
                self._known.clear()
            known = self._known[pair] = self._stay_apart(pair)
        return known

    def encode_all(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces of ``data`` in a row, and how many each has; pieces are in order.

        All pieces are walked together, a byte at a time, with the register as
        an array beside the bytes.
        """
        last = np.zeros(len(data), dtype=np.int64)
        sizes = ends - starts
        together = np.flatnonzero((sizes > 0) & (sizes <= _TOGETHER_BYTES))
        together = together[np.argsort(-sizes[together], kind="stable")]
        at, falling = starts[together], -sizes[together]
        state = np.zeros(len(together), dtype=np.int64)
        for place in range(-int(falling[0]) if len(falling) else 0):
            here = at[: np.searchsorted(falling, -place)] + place
            step = state[: len(here)] << 8 | data[here]
            if (self._next[step] < 0).any():
                self._list_steps(np.unique(step[self._next[step] < 0]).tolist())
            state[: len(here)] = self._next[step]
            ending, left = self._first[step], np.arange(len(here))
            while len(left):
                length, token = self._ends[:, ending[left]]
                ended = length > place
                inner = np.flatnonzero(~ended)
                ended[inner] = self._apart_all(last[here[left[inner]] - length[inner]] << 32 | token[inner])
                last[here[left[ended]]] = token[ended]
                left = left[~ended]
                ending[left] += 1
        marks = np.zeros(len(data), dtype=bool)
        for i in np.flatnonzero(sizes > _TOGETHER_BYTES).tolist():
            ids = np.array(self.encode(data[starts[i] : ends[i]].tobytes()))
            places = starts[i] + np.cumsum(self._lengths[ids]) - 1
            last[places], marks[places] = ids, True
        open_, at = together, ends[together] - 1
        while len(open_):
            marks[at] = True
            at = at - self._lengths[last[at]]
            more = at >= starts[open_]
            open_, at = open_[more], at[more]
        if self._never_made:
            for i in together.tolist():
                if (piece := data[starts[i] : ends[i]].tobytes()) in self._never_made:
                    marks[starts[i] : ends[i]] = False
                    marks[ends[i] - 1], last[ends[i] - 1] = True, self._ranks[piece]
        before = np.concatenate([[0], np.cumsum(marks)])
        return last[marks], before[ends] - before[starts]

    def _list_steps(self, steps: list[int]) -> None:
        """Takes steps into the arrays."""
        for step in steps:
            following, ended = self._numbered[step >> 8][step & 0xFF]
            if 256 * len(self._numbered) > len(self._next):
                self._next = np.concatenate([self._next, np.full(len(self._next), -1, dtype=np.int32)])
                self._first = np.concatenate([self._first, np.zeros(len(self._first), dtype=np.int64)])
            if self._listed + len(ended) > self._ends.shape[1]:
                self._ends = np.concatenate([self._ends, np.zeros_like(self._ends)], axis=1)
            self._next[step], self._first[step] = following.number, self._listed
            self._ends[:, self._listed : self._listed + len(ended)] = np.array(ended).T
            self._listed += len(ended)

    def stream(self, piece: bytes, settle_bytes: int = _SETTLE_BYTES) -> Iterator[list[int]]:
        """Token ids of a piece, as they are settled; the register holds those that are not."""
        last: list[int] = []
        state, gone = self._start, 0
        for start in range(0, len(piece), settle_bytes):
            state = self._walk(piece[start : start + settle_bytes], last, state)
            end = self._settled(last, state)
            yield self._between(last, gone, end)
            del last[:end]
            gone = 1
        yield self._between(last, gone, len(last) - 1)

    def _settled(self, last: list[int], state: _State) -> int:
        """The last byte at which a token ends whatever follows: all open walks come from there."""
        end = len(last) - 1
        ends = {end, *(end - self._depth[node] for node in state.nodes)}
        while len(ends) > 1:
            latest = max(ends)
            ends.remove(latest)
            ends.add(latest - self._length[last[latest]])
        return max(0, ends.pop())

    def _between(self, last: list[int], gone: int, end: int) -> list[int]:
        """The tokens behind those that were emitted, up to the one that ends at ``end``."""
        ids = []
        while end >= gone:
            ids.append(last[end])
            end -= self._length[last[end]]
        return ids[::-1]


def splitter(pattern: str):
    """The splitting pattern, with ``\\s`` as Unicode's white space and nothing else."""
    exact = pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")
    return regex.compile(exact)


_LETTER, _DIGIT, _BLANK, _OTHER = range(4)
_kinds: list[np.ndarray] = []


def _kind_table() -> np.ndarray:
    """Letter, number, white space or other, for every code point; made once a process."""
    if not _kinds:
        kinds = np.full(sys.maxunicode + 1, _OTHER, dtype=np.uint8)
        every = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, sys.maxunicode + 1)))
        for kind, name in ((_LETTER, r"\p{L}+"), (_DIGIT, r"\p{N}+"), (_BLANK, r"\p{White_Space}+")):
            for run in regex.finditer(name, every):
                low, high = ord(every[run.start()]), ord(every[run.end() - 1])
                kinds[low : high + 1] = kind
        _kinds.append(kinds)
    return _kinds[0]


def split_points(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pieces of ``GPT2_PATTERN`` begin in texts given as code points.

    A piece is a run of one kind of character, with one space before it if
    there is one; blanks before that are a piece, and a last blank that is no
    space is one by itself. Runs end where texts end.
    """
    if not len(points):
        return np.empty(0, dtype=np.int64)
    kind = _kind_table()[points]
    starts = np.empty(len(points) + 1, dtype=bool)
    starts[0] = starts[-1] = True
    starts[1:-1] = kind[1:] != kind[:-1]
    starts[bounds] = True
    blank = kind == _BLANK
    # the last blank of a run that something follows in the same text
    tail = blank.copy()
    tail[:-1] &= ~blank[1:]
    tail[bounds[1:][bounds[1:] > bounds[:-1]] - 1] = False
    at = np.flatnonzero(tail)
    starts[at] = True
    spaces = at[points[at] == 0x20]
    starts[spaces + 1] = False
    # contractions: an apostrophe that is a run of its own, then what may follow it
    marks = np.flatnonzero(points == 0x27)
    marks = marks[starts[marks] & starts[marks + 1]]
    ends = np.append(bounds[1:], 0)[np.searchsorted(bounds[1:], marks, side="right")]
    padded = np.append(points, [0, 0])
    one, two = padded[marks + 1], padded[marks + 2]
    one = np.where(marks + 1 < ends, one, 0)
    two = np.where(marks + 2 < ends, two, 0)
    short = np.isin(one, [ord(x) for x in "stmd"])
    long = np.zeros_like(short)
    for first, second in ("re", "ve", "ll"):
        long |= (one == ord(first)) & (two == ord(second))
    for found, size in ((marks[short], 2), (marks[long & ~short], 3)):
        starts[found + 1] = False
        starts[found + size] = True
    return np.flatnonzero(starts[:-1])


class Encoder:
    """Encodes texts, each different piece of a batch once."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memory: int = MEMORY):
        self.transducer = Transducer(ranks, memory)
        self._findall = None if pattern == GPT2_PATTERN else splitter(pattern).findall

    def encode_batch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts in a row, and where each text's ids begin and end."""
        if self._findall is None:
            data, starts, ends, first, which, bounds = self._split(texts)
        else:
            data, starts, ends, first, which, bounds = self._found(texts)
        ids, sizes = self.transducer.encode_all(data, starts[first], ends[first])
        begins = np.cumsum(sizes) - sizes
        counts = sizes[which]
        before = np.concatenate([[0], np.cumsum(counts)])
        at = np.arange(int(before[-1])) + np.repeat(begins[which] - before[:-1], counts)
        return ids[at], before[bounds]

    def _split(self, texts: list[str]):
        """The texts' bytes, where pieces begin and end, which of them are the first of their kind."""
        whole = "".join(texts)
        points = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
        bounds = np.cumsum([0, *map(len, texts)])
        starts = split_points(points, bounds)
        ends = np.append(starts[1:], len(points))
        hashes = word_hashes(points, starts, ends)
        _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
        check = word_hashes(points, starts, ends, other=True)
        if not np.array_equal(check[first][which], check):  # two pieces of one hash: all singly
            first, which = np.arange(len(starts)), np.arange(len(starts))
        order = np.argsort(first)
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        widths = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
        offsets = np.concatenate([[0], np.cumsum(widths)])
        data = np.frombuffer(whole.encode(), dtype=np.uint8)
        return data, offsets[starts], offsets[ends] if len(starts) else ends, first[order], place[which], np.searchsorted(starts, bounds)

    def _found(self, texts: list[str]):
        """The same for any pattern."""
        known: dict[str, int] = {}
        every = [[known.setdefault(piece, len(known)) for piece in self._findall(text)] for text in texts]
        coded = [piece.encode() for piece in known]
        ends = np.cumsum([0, *map(len, coded)], dtype=np.int64)
        data = np.frombuffer(b"".join(coded), dtype=np.uint8)
        which = np.array([number for text in every for number in text], dtype=np.int64)
        return data, ends[:-1], ends[1:], np.arange(len(coded)), which, np.cumsum([0, *map(len, every)])

    def encode(self, text: str) -> list[int]:
        return self.encode_batch([text])[0].tolist()


class Decimals:
    """Ids as decimal text, joined by spaces."""

    def __init__(self, most: int):
        texts = [b"%d " % i for i in range(most + 1)]
        width = max(map(len, texts))
        self._digits = np.frombuffer(b"".join(t.ljust(width, b"\0") for t in texts), np.uint8)
        self._digits = self._digits.reshape(most + 1, width)

    def join(self, ids: np.ndarray) -> bytes:
        digits = self._digits[ids]
        return digits[digits != 0].tobytes()[:-1]


# UTF-8 by a state machine. A state is (bytes still to come, smallest and
# largest next byte, bits so far).
_GROUND = (0, 0, 0, 0)


def _read_byte(state: tuple[int, int, int, int], byte: int) -> tuple[tuple[int, int, int, int], str]:
    """The next state and the characters that are complete by now."""
    missing, low, high, bits = state
    if missing:
        if low <= byte <= high:
            bits = bits << 6 | byte & 0x3F
            return (_GROUND, chr(bits)) if missing == 1 else ((missing - 1, 0x80, 0xBF, bits), "")
        following, text = _read_byte(_GROUND, byte)
        return following, "�" + text
    if byte < 0x80:
        return _GROUND, chr(byte)
    if 0xC2 <= byte <= 0xDF:
        return (1, 0x80, 0xBF, byte & 0x1F), ""
    if 0xE0 <= byte <= 0xEF:
        return (2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF, byte & 0x0F), ""
    if 0xF0 <= byte <= 0xF4:
        return (3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF, byte & 0x07), ""
    return _GROUND, "�"


class Decoder:
    """Streams tokens to text; a character split over tokens waits for its last byte.

    What a token does from a state is worked out once and remembered.
    """

    def __init__(self, tokens: dict[int, bytes], memory: int = MEMORY):
        self._tokens = tokens
        self._memory = memory
        self._steps: dict[tuple, dict[int, tuple[tuple, str]]] = {_GROUND: {}}
        self._whole = {}
        for token, data in tokens.items():
            try:
                self._whole[token] = data.decode()
            except UnicodeDecodeError:
                pass  # needs its neighbours
        most = max(tokens, default=0) + 1
        self._sizes, self._is_whole = np.zeros(most, dtype=np.int64), np.zeros(most, dtype=bool)
        for token, data in tokens.items():
            self._sizes[token], self._is_whole[token] = len(data), token in self._whole
        self._begins = np.cumsum(self._sizes) - self._sizes
        self._bytes = np.frombuffer(b"".join(tokens.get(token, b"") for token in range(most)), dtype=np.uint8)

    def _step(self, state: tuple, token: int) -> tuple[tuple, str]:
        following, text = state, ""
        for byte in self._tokens[token]:
            following, more = _read_byte(following, byte)
            text += more
        if len(self._steps) >= self._memory:
            self._steps.clear()
        return self._steps.setdefault(state, {}).setdefault(token, (following, text))

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Text as it becomes complete, one string per token; bad bytes read as U+FFFD."""
        state, known = _GROUND, self._steps.setdefault(_GROUND, {})
        for token in ids:
            following, text = known.get(token) or self._step(state, token)
            if following is not state:
                state, known = following, self._steps.setdefault(following, {})
            yield text
        if state != _GROUND:
            yield "�"

    def decode_batch(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """UTF-8 of several texts; the state machine reads on where tokens split characters."""
        sizes = self._sizes[ids]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        places = np.arange(int(ends[-1])) + np.repeat(self._begins[ids] - ends[:-1], sizes)
        data = self._bytes[places]
        split = ~self._is_whole[ids]
        texts = []
        for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            raw = data[ends[start] : ends[stop]].tobytes()
            parts = split[start:stop]
            if parts.any() and not self._reads_as(ids[start:stop], parts, ends[start : stop + 1] - ends[start], raw):
                raw = self.decode(ids[start:stop].tolist()).encode()
            texts.append(raw)
        return texts

    def _reads_as(self, ids: np.ndarray, parts: np.ndarray, ends: np.ndarray, raw: bytes) -> bool:
        """Whether every run of tokens that are no whole characters reads as its bytes."""
        edges = np.flatnonzero(np.diff(parts, prepend=False, append=False)).reshape(-1, 2)
        return all(
            "".join(self.stream(ids[a:b].tolist())).encode() == raw[ends[a] : ends[b]] for a, b in edges.tolist()
        )

    def decode(self, ids: list[int]) -> str:
        """All at once; texts in which no token splits a character need no states."""
        try:
            return "".join([self._whole[token] for token in ids])
        except KeyError:
            return "".join(self.stream(ids))


_compiled: dict[tuple[str, str], tuple[Encoder, Decoder, Decimals]] = {}


def compiled(lines: bytes, pattern: str) -> tuple[Encoder, Decoder, Decimals]:
    """One encoder and decoder a worker process for each vocabulary."""
    key = hashlib.sha256(lines).hexdigest(), pattern
    if key not in _compiled:
        encoder = Encoder(parse_ranks(lines), pattern)
        tokens = encoder.transducer.tokens
        _compiled[key] = encoder, Decoder(tokens), Decimals(max(tokens, default=0))
    return _compiled[key]


def _vocabulary(spark, path: str):
    """The rank file, read here and sent once to each executor; its size is the vocabulary's."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``docs`` with ``token_ids`` in place of ``text``; a null or empty text has none."""
    lines = _vocabulary(docs.sparkSession, ranks_path)

    def run(batches):
        encoder, *_ = compiled(lines.value, pattern)
        for piece in pieces(batches, limit=_BATCH_BYTES):
            ids, bounds = encoder.encode_batch([t or "" for t in piece.column("text").to_pylist()])
            lists = pa.ListArray.from_arrays(bounds.astype(np.int32), pa.array(ids.astype(np.int32)))
            yield pa.record_batch([piece.column("row"), lists], names=["row", "token_ids"])

    rows = boxed(docs.drop("token_ids").withColumn("text", F.col("text").cast("string")))
    kinds = T.StructType([rows.schema["row"], T.StructField("token_ids", T.ArrayType(T.IntegerType()))])
    return _replaced(rows.mapInArrow(run, kinds), docs.columns, "text", "token_ids")


def decode_documents(coded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``coded`` with ``text`` in place of ``token_ids``; null reads as no tokens."""
    lines = _vocabulary(coded.sparkSession, ranks_path)

    def run(batches):
        _, decoder, _ = compiled(lines.value, pattern)
        for batch in batches:
            texts = [decoder.decode(ids or []) for ids in batch.column("token_ids").to_pylist()]
            yield pa.record_batch([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    rows = boxed(coded.drop("text"), "token_ids")
    kinds = T.StructType([rows.schema["row"], T.StructField("text", T.StringType())])
    return _replaced(rows.mapInArrow(run, kinds), coded.columns, "token_ids", "text")


def _replaced(rows: DataFrame, columns: list[str], old: str, new: str) -> DataFrame:
    kept = [name for name in columns if name != new]
    return unboxed(rows, [new if name == old else name for name in kept], new)


def bpe_digest(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Per document: number of tokens, and digests of the ids and of what they decode to.

    Encoding and decoding in one pass over the texts. Null texts are empty.
    """
    lines = _vocabulary(docs.sparkSession, ranks_path)

    def run(batches):
        encoder, decoder, decimals = compiled(lines.value, pattern)
        for piece in pieces(batches, limit=_BATCH_BYTES):
            texts = [text or "" for text in piece.column("text").to_pylist()]
            ids, bounds = encoder.encode_batch(texts)
            counts, spans = np.diff(bounds), zip(bounds[:-1].tolist(), bounds[1:].tolist())
            coded = [hashlib.sha256(decimals.join(ids[start:stop])).hexdigest() for start, stop in spans]
            decoded = [hashlib.sha256(again).hexdigest() for again in decoder.decode_batch(ids, bounds)]
            yield pa.record_batch(
                [piece.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.array(coded, pa.string()), pa.array(decoded, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
