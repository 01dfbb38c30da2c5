"""Byte-level BPE: whole texts to token ids and back, by the ranks of a public vocabulary.

Texts are cut into pieces without a regular expression. Every code point gets a class from an array;
each class is a transition function of a small automaton, and as function composition is associative,
the state before every code point comes from a prefix scan over the functions: blocks of the batch are
scanned side by side, the blocks' totals are scanned in turn, and one gather joins the two. The
automaton's moves say where pieces begin. Pieces then go through pair merging, which is cached.

Defined results: null and empty texts have no ids and decode to nothing; a text of any length is
encoded whole, in steps that end where a piece ends; each row is encoded on its own, so ties and
repeated rows do not matter; an empty table gives an empty table; only the named id and text columns
are read.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator
from functools import cache
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame

from tidelog.llm.batches import map_texts

# Code points in one step of a long text, pieces in each of the cache's two generations, bytes of a
# piece that is merged side by side with others, and the rank of a pair that cannot merge.
CHUNK = 1 << 19
CACHE_PIECES = 200_000
SHORT = 48
NEVER = 1 << 30

# Classes of code points. The four letters that end a two-character contraction act alike, and so
# do the r and v that may start a three-character one.
SPACE, BLANK, DIGIT, OTHER, QUOTE, ENDER, OPENER, LETTER_E, LETTER_L, LETTER, BREAK = range(11)

# States: what the piece that is open looks like so far.
(NEW, IN_LETTERS, IN_DIGITS, IN_OTHER, ON_SPACE, ON_BLANK, AFTER_QUOTE, WANTS_E, WANTS_L) = range(9)

# What a move says about piece starts: at this code point, at the one before it.
HERE, BEFORE = 1, 2


@cache
def code_point_classes() -> np.ndarray:
    """The class of every code point, from its Unicode category and white space."""
    classes = np.full(0x110001, OTHER, np.uint8)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))[0]
        if kind == "L":
            classes[i] = LETTER
        elif kind == "N":
            classes[i] = DIGIT
    # The code points with the Unicode property White_Space.
    blanks = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
              0x202F, 0x205F, 0x3000]
    classes[blanks] = BLANK
    classes[0x20] = SPACE
    classes[ord("'")] = QUOTE
    classes[[ord(c) for c in "stmd"]] = ENDER
    classes[[ord(c) for c in "rv"]] = OPENER
    classes[ord("e")], classes[ord("l")] = LETTER_E, LETTER_L
    classes[0x110000] = BREAK
    return classes


def _move(state: int, kind: int) -> tuple[int, int]:
    """The next state, and where pieces begin."""
    if kind == BREAK:
        return NEW, 0
    letter = kind in (ENDER, OPENER, LETTER_E, LETTER_L, LETTER)
    if state == AFTER_QUOTE:
        if kind == ENDER:
            return NEW, 0
        if kind == OPENER:
            return WANTS_E, 0
        if kind == LETTER_L:
            return WANTS_L, 0
        if kind in (OTHER, QUOTE):
            return IN_OTHER, 0
        return _move(NEW, kind)
    if state in (WANTS_E, WANTS_L):
        if kind == (LETTER_E if state == WANTS_E else LETTER_L):
            return NEW, 0
        after, starts = _move(IN_LETTERS, kind)
        return after, starts | BEFORE
    if kind in (SPACE, BLANK):
        open_run = state in (ON_SPACE, ON_BLANK)
        return (ON_SPACE if kind == SPACE else ON_BLANK), (0 if open_run else HERE)
    into = IN_LETTERS if letter else IN_DIGITS if kind == DIGIT else IN_OTHER
    if state == ON_SPACE:  # the last space of a run joins what follows
        return into, BEFORE
    if state == into:
        return into, 0
    if kind == QUOTE:
        return AFTER_QUOTE, HERE | (BEFORE if state == ON_BLANK else 0)
    return into, HERE | (BEFORE if state == ON_BLANK else 0)


@cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Functions as numbers: per class, the product of two, the value at a state; and the starts.

    The functions that sequences of classes can make form a small monoid; it is closed here, so
    composing two of them is one table look-up.
    """
    moves = [tuple(_move(s, k)[0] for s in range(9)) for k in range(11)]
    found = {tuple(range(9)): 0}
    queue = list(found)
    for f in queue:
        for g in moves:
            h = tuple(g[s] for s in f)
            if h not in found:
                found[h] = len(found)
                queue.append(h)
    functions = np.array(list(found), np.uint8)
    product = np.array(
        [[found[tuple(g[s] for s in f)] for g in found] for f in found], np.uint16
    )
    of_class = np.array([found[m] for m in moves], np.uint16)
    starts = np.array([[_move(s, k)[1] for k in range(11)] for s in range(9)], np.uint8)
    return of_class, product, functions, starts


def states_before(classes: np.ndarray) -> np.ndarray:
    """The automaton's state before every code point, by a blocked prefix scan of functions."""
    of_class, product, functions, _ = automaton()
    n = len(classes)
    width = max(1, min(512, int(n ** 0.5)))
    blocks = -(-n // width)
    padded = np.full(blocks * width, BREAK, np.uint8)
    padded[:n] = classes
    single = of_class[padded].reshape(blocks, width).T.copy()
    flat = product.ravel()
    for j in range(1, width):
        single[j] = flat[single[j - 1].astype(np.intp) * len(product) + single[j]]
    entry = np.empty(blocks, np.uint8)
    state = NEW
    for b, f in enumerate(single[-1].tolist()):
        entry[b] = state
        state = functions[f, state]
    before = np.empty((width, blocks), np.uint8)
    before[0] = entry
    before[1:] = functions[single[:-1], entry]
    return before.T.reshape(-1)[:n]


def piece_starts(points: np.ndarray) -> np.ndarray:
    """Whether a piece begins at every code point; 0x110000 stands between two texts."""
    classes = code_point_classes()[points]
    begins = automaton()[3][states_before(classes), classes]
    starts = (begins & HERE) > 0
    starts[:-1] |= (begins[1:] & BEFORE) > 0
    return starts


class Vocabulary:
    """A rank file, its pair merges, and the cached ids of pieces."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            lines = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(piece): int(rank) for piece, rank in lines}
        self.pieces = [b""] * (max(self.ranks.values()) + 1)
        for piece, rank in self.ranks.items():
            self.pieces[rank] = piece
        self.packed = {p: r.to_bytes(4, "little") for p, r in self.ranks.items()}
        self.young: dict[bytes, bytes] = dict(self.packed)
        self.old: dict[bytes, bytes] = {}
        # The id of each byte, -1 for padding, and the rank of each pair of them.
        self.single = np.array([*(self.ranks[bytes([b])] for b in range(256)), -1], np.int32)
        self.byte_pairs = np.full((257, 257), NEVER, np.int32)
        for piece, rank in self.ranks.items():
            if len(piece) == 2:
                self.byte_pairs[piece[0], piece[1]] = rank
        pairs = {
            (self.ranks[p[:i]] << 32) | self.ranks[p[i:]]: rank
            for p, rank in self.ranks.items()
            for i in range(1, len(p))
            if p[:i] in self.ranks and p[i:] in self.ranks
        }
        self.pairs = np.array(sorted(pairs), np.int64)
        self.joined = np.array([pairs[k] for k in self.pairs.tolist()], np.int32)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece: the lowest-ranked pair of neighbours joins first, leftmost on ties."""
        get = self.ranks.get
        end = len(piece)
        after = list(range(1, end + 1))  # where the part that starts here ends
        prior = list(range(-1, end - 1))
        alive = [True] * end
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < end and (rank := get(piece[i:after[j]])) is not None:
                heapq.heappush(heap, (rank, i, after[j]))

        for i in range(end - 1):
            offer(i)
        while heap:
            _, i, stop = heapq.heappop(heap)
            j = after[i] if alive[i] else end
            if j >= end or after[j] != stop:
                continue
            alive[j] = False
            after[i] = stop
            if stop < end:
                prior[stop] = i
            offer(i)
            if prior[i] >= 0:
                offer(prior[i])
        return [get(piece[i:after[i]]) for i in range(end) if alive[i]]

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of what each pair of ids joins to."""
        wanted = (left.astype(np.int64) << 32) | right
        at = np.searchsorted(self.pairs, wanted)
        at[at == len(self.pairs)] = 0
        found = (self.pairs[at] == wanted) & (right >= 0)
        return np.where(found, self.joined[at], NEVER)

    def merge_many(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids of short pieces, merged side by side: one pair of every piece in each round."""
        width = max(map(len, pieces)) + 1
        n = len(pieces)
        sizes = np.fromiter(map(len, pieces), np.intp, n)
        data = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8)
        place = np.arange(width)
        data = np.where(place < sizes[:, None], data.reshape(n, width), 256)
        ids = self.single[data]
        ranks = self.byte_pairs[data[:, :-1], data[:, 1:]]
        rows = np.arange(n)
        done = np.empty_like(ids)
        counts = sizes.copy()
        while len(rows):
            at = ranks.argmin(axis=1)
            each = np.arange(len(rows))
            low = ranks[each, at]
            more = low < NEVER
            if not more.all():
                done[rows[~more]] = ids[~more]
                rows, ids, ranks, at, low = (x[more] for x in (rows, ids, ranks, at, low))
                each = np.arange(len(rows))
                if not len(rows):
                    break
            counts[rows] -= 1
            source = np.minimum(place + (place > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, source, axis=1)
            ids[:, -1] = -1
            ids[each, at] = low
            ranks = np.take_along_axis(ranks, np.minimum(source[:, :-1], width - 2), axis=1)
            ranks[:, -1] = NEVER
            ranks[each, at] = self._pair_ranks(low, ids[each, np.minimum(at + 1, width - 1)])
            inner = at > 0
            left = at[inner] - 1
            ranks[each[inner], left] = self._pair_ranks(ids[each[inner], left], low[inner])
        packed = done.astype("<u4").tobytes()
        step = 4 * width
        return [packed[i * step:i * step + 4 * c] for i, c in enumerate(counts.tolist())]

    def packed_ids(self, pieces: list[bytes]) -> list[bytes]:
        """Each piece's ids as little-endian 32-bit integers."""
        young, old = self.young.get, self.old.get
        out = [young(p) or old(p) for p in pieces]
        missing = {pieces[i] for i, ids in enumerate(out) if ids is None}
        if not missing:
            return out
        found = {}
        short = sorted((p for p in missing if len(p) <= SHORT), key=len)
        for i in range(0, len(short), 4096):
            part = short[i:i + 4096]
            found.update(zip(part, self.merge_many(part), strict=True))
        if len(self.young) + len(found) > CACHE_PIECES:
            self.old, self.young = self.young, dict(self.packed)
        if len(found) <= CACHE_PIECES:
            self.young.update(found)
        for piece in missing:
            if len(piece) > SHORT:
                found[piece] = np.array(self.merge(piece), "<u4").tobytes()
        return [found[p] if ids is None else ids for p, ids in zip(pieces, out, strict=True)]


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _parts(text: str) -> Iterator[tuple[bytes, bool]]:
    """Chunks of a long text that end where a piece ends, as UTF-32, and whether one is the last."""
    at = 0
    size = CHUNK
    while at < len(text):
        chunk = text[at:at + size]
        points = np.frombuffer(chunk.encode("utf-32-le", "replace"), "<u4")
        if at + len(chunk) >= len(text):
            yield points, True
            return
        # Starts close to the end depend on code points that are not here yet.
        safe = np.flatnonzero(piece_starts(points)[:-3])
        if len(safe) < 2:
            size *= 2
            continue
        yield points[:safe[-1]], False
        at += int(safe[-1])
        size = CHUNK


def pieces_of(texts: list[str]) -> list[list[bytes]]:
    """The pieces of every text, as UTF-8."""
    out: list[list[bytes]] = []
    group: list[np.ndarray] = []
    owners: list[int] = []

    def flush() -> None:
        if not group:
            return
        gap = np.array([0x110000], "<u4")
        points = np.concatenate([x for part in group for x in (part, gap)])
        starts = piece_starts(points)
        width = 1 + (points >= 0x80) + (points >= 0x800).astype(np.int8) + (points >= 0x10000)
        width[points == 0x110000] = 0
        offsets = np.concatenate([[0], np.cumsum(width, dtype=np.int64)])
        data = points[points != 0x110000].astype("<u4").tobytes().decode("utf-32-le").encode()
        cuts = offsets[:-1][starts].tolist()
        cuts.append(int(offsets[-1]))
        pieces = [data[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
        ends = np.cumsum([len(part) + 1 for part in group])
        upto = np.cumsum(starts)[ends - 1].tolist()
        for owner, a, b in zip(owners, [0, *upto], upto, strict=False):
            out[owner].extend(pieces[a:b])
        group.clear()
        owners.clear()

    held = 0
    for text in texts:
        out.append([])
        for points, _ in _parts(text):
            group.append(points)
            owners.append(len(out) - 1)
            held += len(points)
            if held >= CHUNK:
                flush()
                held = 0
    flush()
    return out


def encode(texts: list[str | None], path: str) -> list[bytes]:
    """Ids of each text, packed as little-endian unsigned 32-bit integers."""
    split = pieces_of([t or "" for t in texts])
    packed = iter(vocabulary(path).packed_ids([p for pieces in split for p in pieces]))
    return [b"".join(islice(packed, len(pieces))) for pieces in split]


def decode(ids: bytes, path: str) -> bytes:
    """The bytes that packed ids stand for."""
    pieces = vocabulary(path).pieces
    return b"".join(map(pieces.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def token_ends(ids: bytes, path: str) -> np.ndarray:
    """Where each token ends in the decoded bytes, so any span of text finds its ids."""
    pieces = vocabulary(path).pieces
    return np.cumsum([len(pieces[i]) for i in np.frombuffer(ids, "<u4").tolist()], dtype=np.int64)


def decode_span(ids: bytes, ends: bytes, start: int, stop: int, path: str) -> bytes:
    """The text's bytes from ``start`` to before ``stop``, from the tokens that hold them alone."""
    at = np.frombuffer(ends, "<u8")
    first, last = np.searchsorted(at, start, "right"), np.searchsorted(at, stop, "left")
    begin = int(at[first - 1]) if first else 0
    return decode(ids[4 * first:4 * (last + 1)], path)[max(0, start - begin):max(0, stop - begin)]


def encode_texts(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", offsets: bool = False
) -> DataFrame:
    """The id column with ``n_tokens`` and ``ids`` (packed little-endian 32-bit integers).

    With ``offsets`` also ``ends``: where each token ends in the text's bytes, packed as little-endian
    64-bit integers, by which :func:`decode_span` decodes any part of a text.
    """

    def make():
        def step(texts):
            ids = encode(texts, path)
            out = {"n_tokens": [len(x) // 4 for x in ids], "ids": ids}
            if offsets:
                out["ends"] = [token_ends(x, path).astype("<u8").tobytes() for x in ids]
            return out

        return step

    schema = "n_tokens long, ids binary" + (", ends binary" if offsets else "")
    return map_texts(docs, [id_col], text_col, schema, make)


def round_trip(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The id column with ``n_tokens`` and digests of the ids and of what they decode to.

    Ids are hashed where they are made, so that they need not be stored or moved.
    """
    from hashlib import sha256

    def make():
        def step(texts):
            ids = encode(texts, path)
            return {
                "n_tokens": [len(x) // 4 for x in ids],
                "ids_sha256": [sha256(x).hexdigest() for x in ids],
                "decoded_sha256": [sha256(decode(x, path)).hexdigest() for x in ids],
            }

        return step

    return map_texts(
        docs, [id_col], text_col,
        "n_tokens long, ids_sha256 string, decoded_sha256 string", make,
    )
