"""Sequential search by tree-structured Parzen estimators.

Past trials are parted into good and other ones. Each setting gets two densities, one over the values of the good trials and one
over those of the others; new values are drawn from the first, and of several candidates the one with the largest ratio of both
is tried. Several trials may be open at once: while more are proposed, the open ones count as bad, so they are not proposed again.
Only settings and scores are held; what a trial does on Spark is the caller's.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

Settings = dict[str, object]


@dataclass(frozen=True)
class IntRange:
    """Whole numbers from ``low`` to ``high``, both included."""

    low: int
    high: int


class Choices:
    """Density over a list of values without an order: counts, smoothed by one trial spread over all values."""

    def __init__(self, values: Sequence[object], seen: Sequence[object]):
        self.values = list(values)
        self.weights = [(sum(v == s for s in seen) + 1 / len(self.values)) / (len(seen) + 1) for v in self.values]

    def density(self, value: object) -> float:
        return self.weights[self.values.index(value)]

    def draw(self, rnd: random.Random) -> object:
        return rnd.choices(self.values, self.weights)[0]


class Kernels:
    """Density over a range of whole numbers: a bell over each seen value, cut at the ends, and one as wide as the range.

    A bell is as wide as the way to the farther neighbour, within bounds that shrink as trials come in.
    """

    def __init__(self, span: IntRange, seen: Sequence[int]):
        self.span = span
        width = span.high - span.low + 1
        ordered = sorted(seen)
        least = width / min(100.0, 2.0 + len(ordered))
        self.bells: list[tuple[float, float]] = [((span.low + span.high) / 2, float(width))]
        for i, v in enumerate(ordered):
            below = v - (ordered[i - 1] if i else span.low)
            above = (ordered[i + 1] if i + 1 < len(ordered) else span.high) - v
            self.bells.append((float(v), min(max(below, above, least), float(width))))

    def _mass(self, bell: tuple[float, float], low: float, high: float) -> float:
        centre, sigma = bell
        at = lambda x: math.erf((x - centre) / (sigma * math.sqrt(2)))
        return (at(high) - at(low)) / 2

    def density(self, value: int) -> float:
        ends = self.span.low - 0.5, self.span.high + 0.5
        shares = [self._mass(b, value - 0.5, value + 0.5) / self._mass(b, *ends) for b in self.bells]
        return sum(shares) / len(shares)

    def draw(self, rnd: random.Random) -> int:
        centre, sigma = rnd.choice(self.bells)
        while True:
            value = round(rnd.gauss(centre, sigma))
            if self.span.low <= value <= self.span.high:
                return value


Space = Mapping[str, "Sequence[object] | IntRange"]


def _any(space: Space, rnd: random.Random) -> Settings:
    return {name: rnd.randint(v.low, v.high) if isinstance(v, IntRange) else rnd.choice(list(v)) for name, v in space.items()}


def propose(space: Space, done: Sequence[tuple[Settings, float]], pending: Sequence[Settings], rnd: random.Random, candidates: int = 24, good_share: float = 0.15) -> Settings:
    """The next settings to try, given finished trials (larger scores are better) and open ones."""
    ranked = sorted(done, key=lambda t: -t[1])
    cut = max(1, math.ceil(good_share * len(ranked)))
    good = [s for s, _ in ranked[:cut]]
    rest = [s for s, _ in ranked[cut:]] + list(pending)
    kind = lambda v: Kernels if isinstance(v, IntRange) else Choices
    likely = {name: kind(v)(v, [s[name] for s in good]) for name, v in space.items()}
    unlikely = {name: kind(v)(v, [s[name] for s in rest]) for name, v in space.items()}
    drawn = [{name: likely[name].draw(rnd) for name in space} for _ in range(candidates)]
    return max(drawn, key=lambda s: sum(math.log(likely[n].density(s[n])) - math.log(unlikely[n].density(s[n])) for n in space))


def sequential_search(
    score: Callable[[Settings], float], space: Space, trials: int = 50, warm_up: int = 10, seed: int = 42, open_trials: int = 1, candidates: int = 24
) -> list[tuple[Settings, float]]:
    """Settings and scores of all trials, the best first; equal scores keep the order of their trials.

    ``open_trials`` are proposed together and scored side by side, whatever order they finish in, so that a seed always gives
    the same proposals. Settings that come again take the score they had.
    """
    rnd = random.Random(seed)
    done: list[tuple[Settings, float]] = []
    while len(done) < trials:
        opened: list[Settings] = []
        for _ in range(min(open_trials, trials - len(done))):
            first = len(done) + len(opened) < warm_up or not done
            opened.append(_any(space, rnd) if first else propose(space, done, opened, rnd, candidates))
        known = {repr(sorted(s.items())): value for s, value in done}
        new = {repr(sorted(s.items())): s for s in opened if repr(sorted(s.items())) not in known}
        if new:
            with ThreadPool(len(new)) as pool:
                known |= dict(zip(new, pool.map(score, new.values())))
        done += [(s, known[repr(sorted(s.items()))]) for s in opened]
    return sorted(done, key=lambda t: -t[1])
