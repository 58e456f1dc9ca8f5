"""Plan of sequences for a histogram of lengths: configurations and how often each is used.

The configuration program has a variable for every way to fill a sequence: use as few
sequences as possible so that every length is covered as often as it occurs.  Its fractional
solution comes from multiplicative weights.  Every round prices a length by its share of a sequence times
its weight and fills one knapsack table, which gives for each length the most valuable sequence that
holds it.  All of these within ``near`` of the best are used together, in amounts that cover no
length more than once over, and the weight of a length falls exponentially with what covered it.  The prices of any
round over the value of their best sequence are a dual solution, hence a lower bound on the number of
sequences.  The rounds end when as many sequences as the bound leave at most ``tolerance`` of the tokens uncovered.

The fractional uses are rounded by their running total to whole ones, in at most ``_USES`` portions, and down
where a length would be used too often.  What the rounding leaves is solved again as long as that places half of it,
then covered by whole uses at the last weights until ``tolerance`` of the tokens are left, which are packed best
fit, longest first, on counts.  Best fit alone is tried as well, and the plan with fewer sequences is kept.  All work
depends on the capacity alone, not on the number of documents.
"""

import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

_REST_TOLERANCE = 0.05  # of the program for what the rounding of one before it left
_USES = 20_000  # portions of the fractional solution, so at most so many configurations are kept


@dataclass(frozen=True)
class Slots:
    """Places for pieces: the pieces of ``length`` with ranks from ``rank`` on, up to the
    next entry, go to the sequences from ``sequence`` on, all at ``offset``."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int
    best_fit_tokens: int  # that the configuration program left
    bound: float  # no plan has fewer sequences
    by_program: bool  # or by best fit alone, which needed fewer


def knapsack(sizes: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Value of the best filling of every room, one piece of it (0: none), and the room it really fills."""
    value = np.zeros(capacity + 1)
    choice = np.zeros(capacity + 1, np.int64)
    filled = np.zeros(capacity + 1, np.int64)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        value[room], filled[room] = value[room - 1], filled[room - 1]
        if fitting[room]:
            gains = price[:fitting[room]] + value[room - sizes[:fitting[room]]]
            best = int(gains.argmax())
            if gains[best] > value[room]:
                value[room], choice[room], filled[room] = gains[best], sizes[best], room
    return value, choice, filled


def best_sequence(price: np.ndarray, capacity: int) -> list[int]:
    """The lengths of the most valuable sequence; ``price[l]`` is the value of length l.

    Lengths without demand have the price minus infinity.
    """
    sizes = np.flatnonzero(price > -np.inf)
    sizes = sizes[sizes > 0]
    _, choice, filled = knapsack(sizes, price[sizes], capacity)
    return _content(choice, filled, capacity)


def _content(choice: np.ndarray, filled: np.ndarray, room: int) -> list[int]:
    lengths, room = [], int(filled[room])
    while room:
        lengths.append(int(choice[room]))
        room = int(filled[room - lengths[-1]])
    return lengths


def bounded_sequence(price: np.ndarray, left: np.ndarray, capacity: int) -> list[int]:
    """As ``best_sequence``, with at most ``left[l]`` pieces of length l.

    A length that the best sequence has too often is kept as often as it can be, and the room beside it
    is filled again without it.
    """
    price, kept, room = price.copy(), [], capacity
    while room:
        lengths = best_sequence(price[:room + 1], room)
        over = max((l for l in set(lengths) if lengths.count(l) > left[l]), default=0)
        if not over:
            return kept + lengths
        kept += [over] * int(left[over])
        room -= over * int(left[over])
        price[over] = -np.inf
    return kept


@dataclass
class Fraction:
    """A fractional solution in rounds: amounts of the best sequences that hold a length each."""

    bound: float  # by the dual prices
    log_weight: np.ndarray  # by length
    uncovered: float = 1.0  # share of the tokens, with as many sequences as the bound
    total: float = 0.0
    rounds: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)

    def portions(self, number: int) -> Iterator[tuple[list[int], int]]:
        """Configurations with whole uses, ``number`` in all, most at once first come."""
        portion = max(1, -(-number // _USES))
        if not self.total:
            return
        before, scale = 0.0, number / portion / self.total
        for seeds, amounts, choice, filled in self.rounds:
            running = np.floor(before + np.cumsum(amounts) * scale + 0.5)
            uses = np.diff(running, prepend=np.floor(before + 0.5)).astype(np.int64)
            before += float(amounts.sum()) * scale
            for i in np.flatnonzero(uses):
                seed = int(seeds[i])
                yield [seed, *_content(choice, filled, len(choice) - 1 - seed)], int(uses[i]) * portion


def solve_weights(
    demand: np.ndarray, capacity: int, tolerance: float, rate: float = 0.1, near: float = 0.02, rounds: int = 600,
    start: np.ndarray | None = None,
) -> Fraction:
    """The covering program over configurations by multiplicative weights.

    ``start`` has logarithms of the first weights by length, 0 if not given.  ``rate`` is the most by which a logarithm of a weight falls in a round.  After ``rounds``
    rounds the solution is taken as it is; ``uncovered`` tells how good it is.
    """
    sizes = np.flatnonzero(demand)
    need, place = demand[sizes].astype(float), np.zeros(capacity + 1, np.int64)
    place[sizes] = np.arange(len(sizes))
    tokens = float((sizes * need).sum())
    covered, log_weight = np.zeros(len(sizes)), np.zeros(len(sizes)) if start is None else start[sizes]
    found = Fraction(tokens / capacity, np.zeros(capacity + 1))
    while len(sizes) and found.uncovered > tolerance and len(found.rounds) < rounds:
        price = sizes * np.exp(log_weight - log_weight.max())
        value, choice, filled = knapsack(sizes, price, capacity)
        found.bound = max(found.bound, float((price * need).sum() / value[capacity]))
        seeds = np.flatnonzero(price + value[capacity - sizes] >= (1 - near) * value[capacity])

        # All contents at once: the pieces that are added in each step, by sequence.
        room, steps = filled[capacity - sizes[seeds]], [(np.arange(len(seeds)), seeds)]
        live = np.flatnonzero(room)
        while len(live):
            piece = place[choice[room[live]]]
            steps.append((live, piece))
            room[live] = filled[room[live] - sizes[piece]]
            live = live[room[live] > 0]
        rows, pieces = (np.concatenate(x) for x in zip(*steps))

        amounts = need[seeds]
        used = np.bincount(pieces, amounts[rows], len(sizes))
        cut = np.divide(need, used, out=np.ones(len(sizes)), where=used > need)
        least = np.ones(len(seeds))
        np.minimum.at(least, rows, cut[pieces])
        amounts = amounts * least
        used = np.bincount(pieces, amounts[rows], len(sizes)) / need
        amounts, used = amounts / used.max(), used / used.max()
        covered += used
        log_weight -= rate * used
        found.total += float(amounts.sum())
        found.rounds.append((sizes[seeds], amounts, choice, filled))
        part = np.minimum(1, covered * (found.bound / found.total))
        found.uncovered = 1 - float((part * sizes * need).sum() / tokens)
    found.log_weight[sizes] = log_weight - log_weight.max(initial=-np.inf)
    return found


class _Builder:
    """Sequences in runs of equal content, with the slots that fill them."""

    def __init__(self, demand: np.ndarray):
        self.left = demand.astype(np.int64).copy()
        self.given = np.zeros_like(self.left)
        self.rows: list[tuple[int, int, int, int]] = []
        self.sequences = 0
        self.runs: dict[int, list[tuple[int, int]]] = {}  # free places: (first sequence, number)
        self.free: list[int] = []

    def tokens_left(self) -> int:
        return int((self.left * np.arange(len(self.left))).sum())

    def open(self, number: int, room: int) -> int:
        first = self.sequences
        self.sequences += number
        return first

    def fill(self, length: int, first: int, number: int, offset: int) -> None:
        self.rows.append((length, int(self.given[length]), first, offset))
        self.given[length] += number
        self.left[length] -= number

    def use(self, lengths: list[int], number: int, capacity: int) -> None:
        """Sequences of these pieces, ``number`` or as many as there are pieces for."""
        number = min(number, *(int(self.left[l]) // lengths.count(l) for l in set(lengths)))
        if number:
            first, offset = self.open(number, 0), 0
            for length in sorted(lengths, reverse=True):
                self.fill(length, first, number, offset)
                offset += length
            self.keep(capacity - offset, first, number)

    def keep(self, room: int, first: int, number: int) -> None:
        if room and number:
            if room not in self.runs:
                bisect.insort(self.free, room)
                self.runs[room] = []
            self.runs[room].append((first, number))


def plan(histogram: dict[int, int], capacity: int = 2048, tolerance: float = 0.02) -> Slots:
    """Slots for all pieces of a histogram of lengths from 1 to ``capacity``.

    The configuration program places all tokens but a share of ``tolerance`` at most, unless best fit
    alone needs fewer sequences.  No length gives no sequences.
    """
    demand = np.zeros(capacity + 1, np.int64)
    for length, number in histogram.items():
        if not 1 <= length <= capacity:
            raise ValueError(f"No piece of length {length} fits {capacity}")
        demand[length] += number
    full = int(demand[capacity])
    program, alone = _Builder(demand), _Builder(demand)
    for build in (program, alone):
        if full:
            build.fill(capacity, build.open(full, 0), full, 0)
    solution = solve_weights(program.left, capacity, tolerance)
    bound, rest, most_left = solution.bound + full, program.tokens_left(), tolerance * program.tokens_left()
    _use(program, solution, capacity)
    while most_left < program.tokens_left() < rest / 2:
        rest = program.tokens_left()
        solution = solve_weights(program.left, capacity, _REST_TOLERANCE, start=solution.log_weight)
        _use(program, solution, capacity)
    _cover_rest(program, solution, capacity, most_left)
    rest = program.tokens_left()
    _best_fit(program, capacity)
    _best_fit(alone, capacity)
    build = min(program, alone, key=lambda x: x.sequences)
    rows = np.array(sorted(build.rows), np.int64).reshape(-1, 4)
    return Slots(rows[:, 0], rows[:, 1], rows[:, 2], rows[:, 3], build.sequences, rest, bound, build is program)


def _use(build: _Builder, solution: Fraction, capacity: int) -> None:
    for lengths, number in solution.portions(int(solution.bound)):
        build.use(lengths, number, capacity)


def _cover_rest(build: _Builder, solution: Fraction, capacity: int, most_left: float) -> None:
    """Whole uses of configurations for what the rounding left, until ``most_left`` tokens are left.

    A round covers at most a quarter of what is left of a length, or one use of its sequence.
    """
    size = np.arange(capacity + 1)
    start = build.left.copy()
    worth = size * (1 + 0.1 * size / capacity) * np.exp(solution.log_weight)
    while build.tokens_left() > most_left:
        part = np.divide(start - build.left, start, out=np.ones(capacity + 1), where=start > 0)
        price = np.where(build.left > 0, worth * np.exp(-part), -np.inf)
        lengths = bounded_sequence(price, build.left, capacity)
        need = {l: lengths.count(l) for l in set(lengths)}
        number = min(min(int(build.left[l]) // n, max(1, int(start[l] / (4 * n)))) for l, n in need.items())
        build.use(lengths, number, capacity)


def _best_fit(build: _Builder, capacity: int) -> None:
    """The rest, longest first, each where the least room stays."""
    for length in range(capacity, 0, -1):
        while build.left[length] > 0:
            at = bisect.bisect_left(build.free, length)
            if at == len(build.free):
                per = min(capacity // length, int(build.left[length]))
                number = int(build.left[length]) // per
                first = build.open(number, 0)
                for i in range(per):
                    build.fill(length, first, number, i * length)
                build.keep(capacity - per * length, first, number)
                continue
            room = build.free[at]
            first, number = build.runs[room].pop()
            if not build.runs[room]:
                del build.runs[room]
                build.free.pop(at)
            used = min(number, int(build.left[length]))
            build.fill(length, first, used, capacity - room)
            build.keep(room - length, first, used)
            build.keep(room, first + used, number - used)
