"""Token counts by a counting transducer over characters.

The tokenizer (pre-token pattern and pair merges) is compiled into one
deterministic machine that reads a text character by character.  A transition
carries the number of tokens that it adds to the count of the text so far; the
number is negative where a merge takes tokens back.  States are made when they
are first reached.

Why this is exact: the encoding of a pre-token's prefix ends in one token t, and
what stands before t is the encoding of the shorter prefix.  A token may follow
another exactly if both together encode to just these two.  So a state needs,
for each start of a token that may still grow, the token before that start and
the count there, nothing else, and there are finitely many states.

Texts are cut into chunks.  A chunk's state map says what it does from any entry
state: behind the first "word character, then white space" the state no longer
depends on the entry.  A map is the text up to there (``head``), the count from
there on (``body``) and the text since the last such place, which fixes the exit
state (``tail``).  Maps compose associatively; the maps of a text are reduced by
a scan in pairs, wherever its chunks were run.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tonescale.llm.batches import pairs, texts_of

CHUNK = 8192
MAX_STATES = 100_000
MAX_WORDS = 300_000
OVER = 512
#: Stands for the special string; no decoded text holds a lone surrogate.
MARK = "\udfff"
# Contractions of the pre-token pattern, and white space.
SHORT = ("s", "t", "m", "d")
INSIDE = ("letter", "number", "other")
LONG = {"r": "e", "v": "e", "l": "l"}
WHITE = "\t-\r \x85\xa0  -     　"

FRESH = regex.compile(f"[^{WHITE}{MARK}][{WHITE}]|{MARK}")
WORDS = re.compile(f"[{WHITE}]+[^{WHITE}]*")
KINDS = regex.compile(r"(\p{L})|(\p{N})|([" + WHITE + "])")

MAP_SCHEMA = "row bigint, doc_id bigint, bytes bigint, part int, head binary, body bigint, tail binary"


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies, by character."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pairs:
    """Pair merges of a byte-level vocabulary file."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text(encoding="utf-8"))
        letters = byte_letters()
        raw = {tuple(map(letters.__getitem__, t)): i for t, i in spec["model"]["vocab"].items() if all(c in letters for c in t)}
        self.ids = {bytes(t): i for t, i in raw.items()}
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.trie: list[dict[int, int]] = [{}]
        self.token: list[int] = [-1]
        for data, token in self.ids.items():
            node = 0
            for byte in data:
                if byte not in self.trie[node]:
                    self.trie[node][byte] = len(self.trie)
                    self.trie.append({})
                    self.token.append(-1)
                node = self.trie[node][byte]
            self.token[node] = token
        to_id = spec["model"]["vocab"]
        self.rank: dict[tuple[int, int], int] = {}
        self.born: dict[int, tuple[int, int, int]] = {}
        for n, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]):
            pair = to_id[a], to_id[b]
            self.rank[pair] = n
            self.born[to_id[a + b]] = n, *pair
        self.known: dict[tuple[int, int], bool] = {}

    def follows(self, before: int, token: int) -> bool:
        """Whether ``token`` may stand behind ``before`` (-1: the pre-token's start)."""
        pair = before, token
        if pair not in self.known:
            inner = self.born.get(token, (0, -1, -1))[1:]
            self.known[pair] = (inner[0] < 0 or self.apart(*inner, self.born[token][0])) if before < 0 else self.apart(*pair)
        return self.known[pair]

    def apart(self, left: int, right: int, until: int = 1 << 60) -> bool:
        """Whether no merge of a rank below ``until`` crosses the border of two tokens.

        The merges on either side are undone, latest first.  What then meets at
        the border stood there until the undone merge took one of them away.
        """
        while True:
            if self.rank.get((left, right), until) < until:
                return False
            rank_left, rank_right = self.born.get(left, (-1,))[0], self.born.get(right, (-1,))[0]
            if rank_left < 0 and rank_right < 0:
                return True
            if rank_left > rank_right:
                until, left = rank_left, self.born[left][2]
            else:  # of equal merges the leftmost goes first, so here equal ranks cross, too
                until, right = rank_right + 1, self.born[right][1]


#: Of a pre-token not yet begun: (place in the trie since a start, token before it, count there less the count now).
EMPTY = ((0, -1, 0),)


class State(dict):
    """A state: its transitions by character, and what entering it adds to the count."""

    __slots__ = ("adds", "key", "machine")

    def __missing__(self, char: str) -> State:
        target = self.machine.intern(*self.machine.step(self.key, char))
        self[char] = target
        return target


class Transducer:
    """The compiled tokenizer: states are (mode, open starts, pending character)."""

    def __init__(self, path: str):
        self.pairs = Pairs(path)
        self.special = self.pairs.special
        self.states: dict[tuple, State] = {}
        # Words by text: those met lately, and those met before them.
        self.words: dict[str, int] = {}
        self.before: dict[str, int] = {}

    def intern(self, key: tuple, adds: int) -> State:
        full = key, adds
        state = self.states.get(full)
        if state is None:
            if len(self.states) >= MAX_STATES:  # start afresh: memory stays bounded, results do not change
                for old in self.states.values():
                    old.clear()
                self.states.clear()
            state = self.states[full] = State()
            state.machine, state.key, state.adds = self, key, adds
        return state

    def start(self) -> State:
        return self.intern(("start", EMPTY, ""), 0)

    def fresh(self, char: str) -> State:
        """The state behind white space that follows a word character, or behind the special string."""
        return self.start() if char == MARK else self.intern(("white", EMPTY, char), 0)

    def feed(self, starts: tuple, char: str) -> tuple[tuple, int]:
        """Read one character inside a pre-token: open starts, tokens added."""
        total, now = 0, starts
        for byte in char.encode():
            now, adds = self.feed_byte(now, byte)
            total += adds
        return now, total

    def feed_byte(self, starts: tuple, byte: int) -> tuple[tuple, int]:
        trie, tokens, follows = self.pairs.trie, self.pairs.token, self.pairs.follows
        adds, last, longer = None, -1, []
        for node, before, count in starts:
            node = trie[node].get(byte)
            if node is None:
                continue
            token = tokens[node]
            if adds is None and token >= 0 and follows(before, token):
                adds, last = count + 1, token
            if trie[node]:
                longer.append((node, before, count))
        return (*((d, b, n - adds) for d, b, n in longer), (0, last, 0)), adds

    def last(self, state: State, char: str) -> int:
        """What a text's last character adds; a state that nothing leaves is not made.

        Inside a pre-token the first start at which a token ends decides.
        """
        target = state.get(char)
        if target is not None:
            return target.adds
        mode, starts, _ = state.key
        if char > "\x7f" or char == MARK or mode not in INSIDE or mode != self.kind(char):
            return self.step(state.key, char)[1]
        trie, tokens, follows, byte = self.pairs.trie, self.pairs.token, self.pairs.follows, ord(char)
        for node, before, count in starts:
            node = trie[node].get(byte)
            if node is not None and tokens[node] >= 0 and follows(before, tokens[node]):
                return count + 1
        raise ValueError(f"no token ends in {char!r}")

    def step(self, key: tuple, char: str) -> tuple[tuple, int]:
        mode, starts, pending = key
        if char == MARK:
            return ("start", EMPTY, ""), 1
        kind = self.kind(char)
        if mode == "white":
            if kind == "white":
                run, _ = self.feed(starts, pending)
                return ("white", run, char), self.feed(run, char)[1]
            _, held = self.feed(starts, pending)
            alone, adds = self.feed(EMPTY, pending)
            if pending == " ":
                now, more = self.feed(alone, char)
                return (kind, now, ""), adds + more - held
            after, more = self.step(("start", EMPTY, ""), char)
            return after, adds + more - held
        if mode == kind:
            now, adds = self.feed(starts, char)
            return (mode, now, ""), adds
        if mode == "quote":
            if char in SHORT:
                return ("start", EMPTY, ""), self.feed(starts, char)[1]
            if char in LONG:
                now, adds = self.feed(EMPTY, char)
                return ("quoted", now, char), adds
            if kind == "other":
                now, adds = self.feed(starts, char)
                return ("other", now, ""), adds
        if mode == "quoted":
            if char == LONG[pending]:
                quote, one = self.feed(EMPTY, "'")
                two, more = self.feed(quote, pending)
                return ("start", EMPTY, ""), more + self.feed(two, char)[1] - self.feed(EMPTY, pending)[1]
            return self.step(("letter", starts, ""), char)
        now, adds = self.feed(EMPTY, char)
        if kind == "white":
            return ("white", EMPTY, char), adds
        return ("quote" if char == "'" else kind, now, ""), adds

    @staticmethod
    @lru_cache(maxsize=4096)
    def kind(char: str) -> str:
        found = KINDS.match(char)
        return "other" if found is None else ("letter", "number", "white")[found.lastindex - 1]

    @staticmethod
    def run(state: State, text: str) -> tuple[State, int]:
        total = 0
        for char in text:
            state = state[char]
            total += state.adds
        return state, total

    def exit(self, tail: str) -> State:
        return self.run(self.fresh(tail[0]), tail[1:])[0]

    def chunk_map(self, chunk: str) -> tuple[str, int, str | None]:
        first = FRESH.search(chunk)
        if first is None:
            return chunk, 0, None
        at = first.end()
        body = self.body(chunk, at)
        last = len(chunk) - 1
        while not FRESH.fullmatch(chunk, max(0, last - 1), last + 1) and chunk[last] != MARK:
            last -= 1
        return chunk[:at], body, chunk[last:]

    def body(self, chunk: str, at: int) -> int:
        """What the text behind a fresh place adds.

        Every run of white space with the word behind it starts and ends at
        such a place, so words are transitions too, kept by their text.
        """
        if MARK in chunk:
            return self.run(self.fresh(chunk[at - 1]), chunk[at:])[1]
        words, total = self.words, -self.word(chunk[at - 1])
        for word in WORDS.findall(chunk, at - 1):
            adds = words.get(word)
            total += self.word(word) if adds is None else adds
        return total

    def word(self, text: str) -> int:
        if len(self.words) >= MAX_WORDS:
            self.before, self.words = self.words, {}
        adds = self.before.get(text)
        if adds is None:
            state, total = self.run(self.start(), text[:-1])
            adds = total + self.last(state, text[-1])
        self.words[text] = adds
        return adds

    def compose(self, one: tuple, two: tuple) -> tuple:
        (head, body, tail), (head2, body2, tail2) = one, two
        if tail is None:
            return head + head2, body2, tail2
        _, between = self.run(self.exit(tail), head2)
        return head, body + between + body2, tail + head2 if tail2 is None else tail2

    def scan(self, maps: list[tuple]) -> int:
        """Tokens of the text with these chunk maps: neighbours compose in pairs, level by level."""
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        head, body, _ = maps[0]
        return self.run(self.start(), head)[1] + body

    def count(self, text: str) -> int:
        """Tokens of one text, chunk by chunk."""
        return self.scan([self.chunk_map(c) for c in self.chunks(text)])

    def chunks(self, text: str, size: int = CHUNK) -> list[str]:
        for word in self.special:
            text = text.replace(word, MARK)
        return [text[i : i + size] for i in range(0, len(text), size)] or [""]


@lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One machine for each Python worker; it keeps its states between tasks."""
    return Transducer(path)


def _pack(text: str | None) -> bytes | None:
    return None if text is None else text.encode("utf-8", "surrogatepass")


def _unpack(data: bytes | None) -> str | None:
    return None if data is None else data.decode("utf-8", "surrogatepass")


def count_tokens(docs: DataFrame, tokenizer: str, over: int = OVER, chunk: int = CHUNK) -> DataFrame:
    """Tokens of every whole text: doc_id, n_bytes, n_tokens, over_limit.

    ``tokenizer`` is the path of a byte-level vocabulary file, readable by
    every executor.  One row for each input row, repeated and missing ids
    included; a missing or empty text has no token.  Other columns are ignored.
    Chunks of a text are keyed by a row number of the input partition, so the
    input must be one that Spark can compute again in the same order (a table).
    """
    names = [column.split()[0] for column in MAP_SCHEMA.split(", ")]
    rows = texts_of(docs).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")

    def maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(tokenizer)
        for batch in batches:
            out: list[tuple] = []
            for row, doc_id, text in pairs(batch):
                size = len(text.encode())
                for part, piece in enumerate(machine.chunks(text, chunk)):
                    head, body, tail = machine.chunk_map(piece)
                    out.append((row, doc_id, 0 if part else size, part, _pack(head), body, _pack(tail)))
            columns = zip(*out) if out else [[] for _ in names]
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = transducer(tokenizer)
        for batch in batches:
            counts = [
                machine.scan([(_unpack(m["head"]), m["body"], _unpack(m["tail"])) for m in parts])
                for parts in (value.as_py() for value in batch.column("maps"))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    chunked = rows.mapInArrow(maps, MAP_SCHEMA)
    by_text = chunked.groupBy("row", "doc_id").agg(
        F.sum("bytes").alias("n_bytes"),
        F.sort_array(F.collect_list(F.struct("part", "head", "body", "tail"))).alias("maps"),
    )
    counted = by_text.mapInArrow(totals, "doc_id bigint, n_bytes bigint, n_tokens bigint")
    return counted.withColumn("over_limit", F.col("n_tokens") > over)
