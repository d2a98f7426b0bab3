"""Byte-level BPE by a lazily determinised finite-state transducer, and streaming decoding.

The merges define which pairs of tokens may stand side by side: a and b may if merging the
bytes of both from scratch gives just a, b.  The token sequence in which all neighbours may
stand side by side is the one that the merges produce, and each prefix of the input has
exactly one.  The transducer reads bytes.  Its state holds, for each place where a token
under way may have begun, the token before it and the bytes since; a move says which token
ends at the byte read.  Tokens before a border that all tokens under way share are emitted:
what comes later cannot change them, and a border lies behind by a few token lengths only.
States and moves are made when first met and forgotten beyond MOST_STATES.

Defined cases: a null text is an empty one and has no tokens; any valid text round-trips.
Texts are encoded whole, whatever their length; repeated rows are encoded each.  Other columns are ignored.  An empty
table gives no rows.
"""

from __future__ import annotations

import base64
import functools
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex

from .common import Pool, chunks, frugal, plain, spread, table, units

#: Bytes of text that are encoded at a time: each distinct unit once.
CHUNK = 16 << 20
#: Bounds of what a worker keeps; bytes after which a long piece is looked at for tokens that are settled.
MOST_STATES, MOST_PAIRS, BLOCK = 250_000, 300_000, 1024
#: A space after one of these does not begin a piece of its own; such texts are split whole.
GAP = r"[\p{Z}\x09-\x0d\x1c-\x1f\x85] "


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes_of: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for t, r in ranks.items():
            self.bytes_of[r] = t
        # The trie of all tokens: child[node << 8 | byte], the token that a node is, and whether it goes on.
        self.child: dict[int, int] = {}
        self.token_at, self.inner = [-1], [True]
        for t, r in ranks.items():
            node = 0
            for byte in t:
                self.inner[node] = True
                node = self.child.setdefault(node << 8 | byte, len(self.token_at))
                if node == len(self.token_at):
                    self.token_at.append(-1)
                    self.inner.append(False)
            self.token_at[node] = r
        self.pairs: dict[int, bool] = {}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self._forget()

    def _forget(self) -> None:
        """A state is a tuple of (the token before, plus 1) << 24 | trie node, the longest node first; moves[state << 8 | byte] is the next state << 24 | the token that ends."""
        self.numbers, self.states, self.moves = {(0,): 0}, [(0,)], {}

    def merge(self, piece: bytes, until: int = 1) -> list[int]:
        """The merges themselves: the adjacent pair of lowest rank first, the leftmost of equals; stops at `until` parts."""
        parts, get = [piece[i : i + 1] for i in range(len(piece))], self.ranks.get
        costs = [get(a + b, 1 << 60) for a, b in zip(parts, parts[1:], strict=False)]
        while len(parts) > until:
            best = min(costs)
            if best == 1 << 60:
                break
            i = costs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del costs[i]
            if i < len(costs):
                costs[i] = get(parts[i] + parts[i + 1], 1 << 60)
            if i:
                costs[i - 1] = get(parts[i - 1] + parts[i], 1 << 60)
        return [self.ranks[p] for p in parts]

    def _halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made this one; None for a byte or a token that no merges make."""
        if token not in self.halves:
            two = self.merge(self.bytes_of[token], 2) if len(self.bytes_of[token]) > 1 else []
            self.halves[token] = (two[0], two[1]) if len(two) == 2 else None
        return self.halves[token]

    def may_follow(self, a: int, b: int) -> bool:
        """Whether merging the bytes of both from scratch leaves the border between them.

        Seen backwards in time: the later merge of the two is undone, which lays another token open
        at the border; had the two there met before that merge, theirs would have come first.
        Merges run from the left, so at equal ranks the left one was the earlier.
        """
        known = self.pairs.get(a << 24 | b)
        if known is None:
            if len(self.pairs) > MOST_PAIRS:
                self.pairs.clear()
            known = self.pairs[a << 24 | b] = self._border_stays(a, b)
        return known

    def _border_stays(self, left: int, right: int) -> bool:
        if len(self.bytes_of[right]) > 1 and self._halves(right) is None:
            return False
        if left < 0:
            return True
        bound = 1 << 60
        while True:
            if self.ranks.get(self.bytes_of[left] + self.bytes_of[right], 1 << 60) < bound:
                return False
            a, b = self._halves(left), self._halves(right)
            if a is None and b is None:
                return True
            if b is None or a is not None and left > right:
                bound, left = left, a[1]
            else:
                bound, right = right + 1, b[0]

    def _move(self, state: int, byte: int) -> int:
        alive, ended, child = [], -1, self.child
        for way in self.states[state]:
            node = child.get((way & 0xFFFFFF) << 8 | byte)
            if node is None:
                continue
            if ended < 0:
                token = self.token_at[node]
                if token >= 0 and self.may_follow((way >> 24) - 1, token):
                    ended = token
            if self.inner[node]:
                alive.append(way >> 24 << 24 | node)
        if ended < 0:
            raise ValueError("these ranks leave bytes without a token")
        alive.append(ended + 1 << 24)
        key = tuple(alive)
        number = self.numbers.setdefault(key, len(self.states))
        if number == len(self.states):
            self.states.append(key)
        move = self.moves[state << 8 | byte] = number << 24 | ended
        return move

    def encode(self, piece: bytes) -> list[int]:
        if (token := self.ranks.get(piece)) is not None:
            return [token]
        return [t for some in self.stream(piece) for t in some]

    def stream(self, piece: bytes):
        """Yields lists of tokens, each as soon as no later byte can change them, looked at every BLOCK bytes."""
        if len(self.states) > MOST_STATES:
            self._forget()
        state, moves, ends = 0, self.moves, []  # ends: the token that ends at each byte not yet emitted
        for byte in piece:
            move = moves.get(state << 8 | byte)
            if move is None:
                move = self._move(state, byte)
            state = move >> 24
            ends.append(move & 0xFFFFFF)
            if len(ends) >= BLOCK:
                here = self.states[state]
                done = self._settled(ends, here)
                if done:
                    yield self._back(ends, done)
                    ends = ends[done:]
                if len(self.states) > MOST_STATES:
                    self._forget()
                    moves, state = self.moves, self.numbers.setdefault(here, len(self.states))
                    if state == len(self.states):
                        self.states.append(here)
        yield self._back(ends, len(ends))

    def _back(self, ends: list[int], to: int) -> list[int]:
        out = []
        while to > 0:
            out.append(ends[to - 1])
            to -= len(self.bytes_of[out[-1]])
        return out[::-1]

    def _settled(self, ends: list[int], state) -> int:
        """The last border that all tokens under way have before them."""
        at = {len(ends) - self._depths[way & 0xFFFFFF] for way in state}
        while len(at) > 1:
            far = max(at)
            at = at - {far} | {far - len(self.bytes_of[ends[far - 1]])}
        return at.pop()

    @functools.cached_property
    def _depths(self) -> list[int]:
        depths = [0] * len(self.token_at)
        for key, node in self.child.items():
            depths[node] = depths[key >> 8] + 1  # a node is made after its parent
        return depths


class Utf8Machine:
    """Incremental UTF-8: feed() returns the text that is certain and holds back an unfinished character.

    States: 0 between characters, 1 to 3 that many bytes to come, 4 to 7 after E0, ED, F0, F4, whose
    next byte has a narrower range, 8 an error.  Malformed bytes become U+FFFD.
    """

    #: Lead bytes by range: first, last, next state; then the allowed range of the byte in states 4 to 7 and the state after it.
    LEADS = ((0x00, 0x7F, 0), (0xC2, 0xDF, 1), (0xE0, 0xE0, 4), (0xE1, 0xEC, 2), (0xED, 0xED, 5), (0xEE, 0xEF, 2), (0xF0, 0xF0, 6), (0xF1, 0xF3, 3), (0xF4, 0xF4, 7))
    NARROW = {4: (0xA0, 0xBF, 1), 5: (0x80, 0x9F, 1), 6: (0x90, 0xBF, 2), 7: (0x80, 0x8F, 2)}

    def __init__(self):
        self.held = b""

    @classmethod
    def step(cls, state: int, byte: int) -> int:
        if state == 0:
            return next((s for a, b, s in cls.LEADS if a <= byte <= b), 8)
        low, high, then = cls.NARROW.get(state, (0x80, 0xBF, state - 1))
        return then if low <= byte <= high else 8

    def feed(self, data: bytes) -> str:
        data = self.held + data
        hold = 0
        for back in range(1, min(3, len(data)) + 1):
            if data[-back] >= 0xC0:  # the last lead byte; the machine says whether its character is complete
                state = 0
                for byte in data[-back:]:
                    state = self.step(state, byte) if state != 8 else 8
                    if state == 0:
                        break
                hold = back if 0 < state < 8 else 0
                break
            if data[-back] < 0x80:
                break
        self.held = data[len(data) - hold :]
        return data[: len(data) - hold].decode("utf-8", "replace")

    def end(self) -> str:
        held, self.held = self.held, b""
        return held.decode("utf-8", "replace")


class Codec:
    """Encoding and decoding by a rank file; `pattern` splits texts into the pieces that are encoded separately."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.transducer = Transducer(ranks)
        # \s is the property White_Space for the library whose results these are; here it would take in U+001C to U+001F as well.
        self.split = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")).findall
        self.token_bytes = np.array(self.transducer.bytes_of, dtype=object)
        self.pool = Pool(self._encode_all, np.int32)

    def encode(self, text: str) -> list[int]:
        return [t for piece in self.split(text) for t in self.transducer.encode(piece.encode("utf-8"))]

    def _encode_all(self, texts: list[str]) -> list[list[int]]:
        encode, split, known, out = self.transducer.encode, self.split, {}, []
        for text in texts:
            if text[:1] == " " and text[1:].isalpha():  # one piece
                out.append(encode(text.encode("utf-8")))
                continue
            ids: list[int] = []
            for piece in split(text):
                got = known.get(piece)
                if got is None:
                    got = known[piece] = encode(piece.encode("utf-8"))
                ids += got
            out.append(ids)
        return out

    def decode(self, ids, step: int = 1 << 16):
        """Yields the text of the ids in pieces, each as soon as it is certain."""
        machine = Utf8Machine()
        for at in range(0, len(ids), step):
            yield machine.feed(b"".join(self.token_bytes[ids[at : at + step]].tolist()))
        yield machine.end()

    def encode_column(self, col: pa.Array):
        """Yields the ids of each text, as an array, and their decimal form joined by commas."""
        col = plain(col)
        whole = np.asarray(pc.match_substring_regex(col, GAP))
        codes, offsets, distinct = units(pc.if_else(pa.array(whole), "", col))
        names = distinct.to_pylist()
        # A unit that does not begin its text has the space before it.
        firsts = offsets[:-1]
        begin, first_at = np.unique(codes[firsts], return_inverse=True)
        codes[firsts] = len(names) + first_at
        starts, lengths, ids = self.pool.of([f" {u}" for u in names] + [names[i] for i in begin])
        text_of = np.array(list(map(str, ids.tolist())), dtype=object)
        decimal = np.array([",".join(text_of[s : s + n]) for s, n in zip(starts.tolist(), lengths.tolist(), strict=True)], dtype=object)
        for row in range(len(col)):
            if whole[row]:
                own = np.asarray(self.encode(col[row].as_py()), dtype=np.int32)
                yield own, ",".join(map(str, own.tolist()))
                continue
            at = codes[offsets[row] : offsets[row + 1]]
            n = lengths[at]
            ends = np.cumsum(n)
            own = ids[np.arange(ends[-1]) + np.repeat(starts[at] - (ends - n), n)]
            if not n[0]:
                at = at[1:]
            yield own, ",".join(decimal[at].tolist())


def round_trip(docs, doc_id: str, text: str, path: str, pattern: str):
    """doc_id, n_tokens, ids_sha256, decoded_sha256: every text encoded, and its ids decoded again by the streaming decoder."""

    def told(batches):
        own = Codec(path, pattern)
        for batch in batches:
            for part in chunks(batch, text, CHUNK):
                rows = []
                for ids, decimal in own.encode_column(part.column(1)):
                    digest = hashlib.sha256()
                    for said in own.decode(ids):
                        digest.update(said.encode("utf-8"))
                    rows.append((len(ids), hashlib.sha256(decimal.encode()).hexdigest(), digest.hexdigest()))
                n, a, b = zip(*rows, strict=True)
                yield pa.record_batch([part.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    def run(batches):
        with frugal(collect=False):  # outside told(), whose codec is gone by then
            yield from told(batches)

    return docs.select(doc_id, text).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op9_bpe_round_trip(spark, sf_dir):
    return round_trip(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id", "text", public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
