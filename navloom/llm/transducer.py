"""Merge rules of a byte-pair vocabulary as a lazily determinised transducer.

Byte-pair encoding has one valid segmentation of every prefix, and a segmentation is valid
exactly if all its neighbouring tokens are *stable*: the merges that made them leave no
cheaper merge across their seam. So reading left to right it is enough to know, for each
earlier boundary that a token may still start from, the tokens up to there. A state is the
set of those open hypotheses; tokens on which all of them agree are emitted, so a token
comes out at the latest when no longer token can start before it. States and transitions
are made when a text first needs them.
"""

from __future__ import annotations

import marshal
from collections.abc import Iterable

import numpy as np

NEVER = 1 << 62


class MergeRules:
    """Tokens with the order in which their merges are made.

    ``order`` maps a token (bytes or text) to its merge rank, lowest first. Tokens of one
    symbol (a byte, a character) are there from the start and never merged into being.
    """

    def __init__(self, order: dict):
        self.order = order
        self.prefixes = {t[:n] for t in order for n in range(1, len(t))}
        self._parts: dict = {}
        self._stable: dict = {}

    def made(self, token) -> int:
        return self.order[token] if len(token) > 1 else -1

    def merge(self, symbols: list, below: int = NEVER) -> list:
        """Repeatedly join the leftmost pair of least rank, for ranks under ``below``."""
        parts = list(symbols)
        while len(parts) > 1:
            ranks = [self.order.get(a + b, NEVER) for a, b in zip(parts, parts[1:])]
            least = min(ranks)
            if least >= below or least == NEVER:
                break
            at = ranks.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def parts(self, token) -> tuple | None:
        """The two tokens whose merge makes ``token``; None if no merges lead to it."""
        found = self._parts.get(token, self)
        if found is self:
            symbols = [token[i : i + 1] for i in range(len(token))]
            left = self.merge(symbols, self.order[token])
            found = self._parts[token] = tuple(left) if len(left) == 2 else None
        return found

    def reachable(self, token) -> bool:
        return len(token) == 1 or self.parts(token) is not None

    def stable(self, left, right) -> bool:
        """Whether the merges of ``left + right`` end in just these two tokens.

        The merges of both sides are undone, latest first. Of equal merges the left one
        was made first. A merge across the seam must not have come before the merges
        that took its two pieces away.
        """
        key = (left, right)
        if (known := self._stable.get(key)) is not None:
            return known
        if len(self._stable) > 200_000:
            self._stable.clear()
        a, b, a_gone, b_gone = left, right, NEVER, NEVER
        while True:
            across = self.order.get(a + b, NEVER)
            if across < a_gone and across <= b_gone and across < NEVER:
                self._stable[key] = False
                return False
            a_made, b_made = self.made(a), self.made(b)
            if a_made < 0 and b_made < 0:
                self._stable[key] = True
                return True
            if a_made > b_made:
                a, a_gone = self.parts(a)[1], a_made
            else:
                b, b_gone = self.parts(b)[0], b_made


class Transducer:
    """Reads the symbols of a piece, emits its tokens.

    ``symbols`` turns a code (a byte, a code point) into the token of one symbol;
    ``number_of`` has the tokens' numbers. When
    ``most`` states are known, pieces that need further ones are walked without keeping
    them, so memory is bounded and frequent pieces stay fast.
    """

    def __init__(self, rules: MergeRules, symbols, number_of: dict, most: int = 100_000):
        self.rules, self.symbols, self.number_of, self.most = rules, symbols, number_of, most
        start = (((), None, None),)
        # Packed, a state takes a tenth of the memory; only new transitions unpack one.
        self.states = [marshal.dumps(start, 2)]
        self.ids = {self.states[0]: 0}
        self.next: dict[int, int] = {}
        self.emits: dict[int, tuple] = {}
        self.rest: list[tuple] = [()]
        self._lists: dict[tuple, tuple] = {}
        self._compiled: Compiled | None = None

    def _step(self, state: tuple, code: int) -> tuple[tuple, tuple]:
        """The hypotheses after one more symbol, and the tokens they now agree on."""
        rules, symbol, entries, ending = self.rules, self.symbols(code), [], None
        for chain, last, read in state:
            longer = symbol if read is None else read + symbol
            if longer in rules.prefixes:
                entries.append((chain, last, longer))
            if (
                ending is None
                and longer in rules.order
                and (last is None or rules.stable(last, longer))
                and rules.reachable(longer)
            ):
                ending = (chain + (longer,), longer, None)
        if ending is None:
            raise ValueError(f"no token for {symbol!r}")
        entries.append(ending)
        first, agreed = entries[0][0], 0
        shortest = min(len(chain) for chain, _, _ in entries)
        while agreed < shortest and all(e[0][agreed] == first[agreed] for e in entries):
            agreed += 1
        if agreed:
            entries = [(chain[agreed:], last, read) for chain, last, read in entries]
        return tuple(entries), first[:agreed]

    @staticmethod
    def _held(state: tuple) -> tuple:
        """The tokens not yet emitted if the input ends here."""
        return next(chain for chain, _, read in state if read is None)

    def run(self, codes: Iterable[int]) -> list:
        """All tokens of a piece."""
        number, out, following, codes = 0, [], self.next, iter(codes)
        for code in codes:
            key = number << 21 | code
            after = following.get(key)
            if after is None:
                state, emitted = self._step(marshal.loads(self.states[number]), code)
                packed = marshal.dumps(state, 2)
                after = self.ids.get(packed)
                if after is None:
                    if len(self.states) >= self.most:
                        out.extend(emitted)
                        return self._walk(state, codes, out)
                    after = self.ids[packed] = len(self.states)
                    self.states.append(packed)
                    self.rest.append(self._shared(self._held(state)))
                following[key] = after
                if emitted:
                    self.emits[key] = self._shared(emitted)
            if key in self.emits:
                out.extend(self.emits[key])
            number = after
        out.extend(self.rest[number])
        return out

    def _shared(self, tokens: tuple) -> tuple:
        """One object for equal lists of tokens."""
        return self._lists.setdefault(tokens, tokens)

    def _walk(self, state: tuple, codes: Iterable[int], out: list) -> list:
        """The rest of a piece, without keeping states."""
        for code in codes:
            state, emitted = self._step(state, code)
            out.extend(emitted)
        out.extend(self._held(state))
        return out

    def compiled(self) -> "Compiled":
        """The known transitions as arrays; made anew when they have grown by a tenth."""
        if self._compiled is None or len(self.next) > 1.1 * self._compiled.size:
            self._compiled = Compiled(self)
        return self._compiled

    def run_many(self, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token numbers of many pieces, laid one after the other, and each piece's count.

        The pieces go through the known transitions side by side. Those that need others
        are read alone afterwards, which makes the transitions.
        """
        starts = np.cumsum(sizes) - sizes
        piece, number, missed = self.compiled().run(codes, starts, sizes)
        if len(missed):
            alone = [self.run(codes[starts[i] : starts[i] + sizes[i]].tolist()) for i in missed]
            counts = [len(tokens) for tokens in alone]
            piece = np.concatenate([piece, np.repeat(missed, counts)])
            of = self.number_of
            more = np.fromiter((of[t] for tokens in alone for t in tokens), np.int32, sum(counts))
            number = np.concatenate([number, more])
        order = np.argsort(piece, kind="stable")
        return number[order], np.bincount(piece, minlength=len(sizes))

    def count_many(self, codes: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Only the number of tokens of each piece: transitions annotated with counts."""
        starts = np.cumsum(sizes) - sizes
        counts, missed = self.compiled().count(codes, starts, sizes)
        for i in missed:
            counts[i] = len(self.run(codes[starts[i] : starts[i] + sizes[i]].tolist()))
        return counts


class Compiled:
    """Transitions in an open-addressing table of arrays, for many pieces at once."""

    LONGEST = 64

    def __init__(self, machine: Transducer):
        self.size = len(machine.next)
        self.bits = max(8, int(self.size * 3).bit_length())
        keys = np.fromiter(machine.next.keys(), np.int64, self.size)
        after = np.fromiter(machine.next.values(), np.int32, self.size)
        lists = [(), *machine.emits.values()]
        emitted = np.zeros(self.size, np.int32)
        at = {key: i for i, key in enumerate(machine.emits, 1)}
        if at:
            emitted = np.fromiter((at.get(k, 0) for k in machine.next), np.int32, self.size)
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.after = np.zeros(1 << self.bits, np.int32)
        self.emitted = np.zeros(1 << self.bits, np.int32)
        slot, left = self._slot(keys), np.arange(self.size)
        while len(left):
            free = self.keys[slot[left]] < 0
            self.keys[slot[left[free]]] = keys[left[free]]
            placed = self.keys[slot[left]] == keys[left]
            self.after[slot[left[placed]]] = after[left[placed]]
            self.emitted[slot[left[placed]]] = emitted[left[placed]]
            left = left[~placed]
            slot[left] = (slot[left] + 1) & ((1 << self.bits) - 1)
        of = machine.number_of
        self.lists = self._flat([[of[t] for t in tokens] for tokens in lists])
        self.rest = self._flat([[of[t] for t in tokens] for tokens in machine.rest])

    @staticmethod
    def _flat(lists: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sizes = np.array([len(x) for x in lists], np.int64)
        flat = np.fromiter((i for x in lists for i in x), np.int32, int(sizes.sum()))
        return flat, np.cumsum(sizes) - sizes, sizes

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 if it is not there."""
        slot = self._slot(keys)
        there = self.keys[slot]
        open_ = np.flatnonzero(there != keys)
        while len(open_):
            empty = there[open_] < 0
            slot[open_[empty]] = -1
            open_ = open_[~empty]
            slot[open_] = (slot[open_] + 1) & ((1 << self.bits) - 1)
            there[open_] = self.keys[slot[open_]]
            open_ = open_[there[open_] != keys[open_]]
        return slot

    def count(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """Tokens of each piece; pieces that met an unknown transition or are long."""
        total = np.zeros(len(sizes), np.int64)

        def add(lists: tuple, lanes: np.ndarray, which: np.ndarray) -> None:
            total[lanes] += lists[2][which]

        return total, self._side_by_side(codes, starts, sizes, add)

    def run(self, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
        """Pieces and token numbers of all emissions, in order within a piece; pieces that
        met an unknown transition or are long."""
        number, pieces = [], []

        def emit(lists: tuple, lanes: np.ndarray, which: np.ndarray) -> None:
            flat, begin, lengths = lists
            counts = lengths[which]
            if len(lanes) and counts.any():
                pieces.append(np.repeat(lanes, counts))
                number.append(gathered(flat, begin[which], counts)[0])

        missed = self._side_by_side(codes, starts, sizes, emit)
        pieces = np.concatenate(pieces) if pieces else np.empty(0, np.int64)
        number = np.concatenate(number) if number else np.empty(0, np.int32)
        if len(missed):
            lost = np.zeros(len(sizes), bool)
            lost[missed] = True
            kept = ~lost[pieces]
            pieces, number = pieces[kept], number[kept]
        return pieces, number, missed

    def _side_by_side(self, codes, starts, sizes, said) -> np.ndarray:
        """One position of all pieces after the other; ``said(lists, pieces, which)`` gets
        what they emit. Returns the pieces that need more than the known transitions."""
        order = np.argsort(-sizes, kind="stable")
        long = int(np.searchsorted(-sizes[order], -self.LONGEST))
        missed, order = [order[:long]], order[long:]
        lanes, lengths, begin = order, sizes[order], starts[order]
        states = np.zeros(len(order), np.int64)
        for at in range(int(lengths[0]) if len(lengths) else 0):
            live = int(np.searchsorted(-lengths, -at))
            if live < len(lanes):
                said(self.rest, lanes[live:], states[live:])
                lanes, lengths, begin = lanes[:live], lengths[:live], begin[:live]
                states = states[:live]
            slot = self.find(states << 21 | codes[begin + at])
            if (slot < 0).any():
                known = slot >= 0
                missed.append(lanes[~known])
                lanes, lengths, begin = lanes[known], lengths[known], begin[known]
                slot = slot[known]
            states = self.after[slot].astype(np.int64)
            some = np.flatnonzero(self.emitted[slot])
            said(self.lists, lanes[some], self.emitted[slot[some]])
        said(self.rest, lanes, states)
        return np.concatenate(missed)


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """The named runs of ``flat`` one after the other, and where each ends."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(starts - (ends - sizes), sizes)
    return flat[shift + np.arange(total)], ends
