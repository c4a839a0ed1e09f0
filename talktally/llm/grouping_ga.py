"""Bin packing by a grouping genetic algorithm on a bounded list of lengths.

A packing is a list of bins, a bin the list of its items. Crossover takes whole
well-filled bins of one parent into the other, drops the other's bins that share an item
with them, and puts the displaced items back by best fit, the longest first. Mutation
empties some bins, the least filled among them, in the same way. A packing with as few
bins as the total length allows cannot be bettered, which ends the search.
"""

from __future__ import annotations

import random
from bisect import bisect_left, bisect_right, insort
from dataclasses import dataclass

Bins = list[list[int]]


@dataclass(frozen=True)
class Effort:
    population: int = 8
    generations: int = 60
    elites: int = 2


def fewest_bins(lengths: list[int], capacity: int) -> int:
    return -(-sum(lengths) // capacity)


def best_fit(bins: Bins, items: list[int], lengths: list[int], capacity: int) -> Bins:
    """Put each item, in the given order, where it leaves the least room."""
    count = len(bins) + len(items) + 1
    rooms = sorted(
        (capacity - sum(lengths[i] for i in b)) * count + at for at, b in enumerate(bins)
    )
    for item in items:
        need = lengths[item]
        place = bisect_left(rooms, need * count)
        if place < len(rooms):
            room, at = divmod(rooms.pop(place), count)
            bins[at].append(item)
        else:
            room, at = capacity, len(bins)
            bins.append([item])
        if room > need:
            insort(rooms, (room - need) * count + at)
    return bins


def exact_fit(items: list[int], lengths: list[int], capacity: int, rng: random.Random) -> Bins:
    """Bins begun by the longest item left and filled up by one, two or three others.

    Fills that leave no room come first; where there is none, the longest item that fits
    goes in and the search goes on from there.
    """
    left: dict[int, list[int]] = {}
    for i in sorted(items, key=lambda i: lengths[i]):
        left.setdefault(lengths[i], []).append(i)
    sizes = sorted(left)

    def take(size: int) -> int:
        found = left[size].pop()
        if not left[size]:
            del left[size]
            sizes.pop(bisect_left(sizes, size))
        return found

    def pair(room: int) -> int | None:
        """The longer of two sizes that fill the room, from a random place on, even halves first."""
        low = bisect_left(sizes, -(-room // 2))
        for size in sizes[low + rng.randrange(4) : low + 400]:
            if size >= room:
                break
            rest = left.get(room - size)
            if rest and (room - size != size or len(rest) > 1):
                return size
        return None

    def triple(room: int) -> int | None:
        low = bisect_left(sizes, room // 4)
        for size in sizes[low : low + 24]:
            if size < room:
                one = left[size].pop()
                found = pair(room - size)
                left[size].append(one)
                # The pair may have counted on the item just put back.
                if found is not None and size not in (found, room - size - found):
                    return size
        return None

    bins = []
    while sizes:
        bins.append([take(sizes[-1])])
        room = capacity - lengths[bins[-1][0]]
        while sizes and room >= sizes[0]:
            if room in left:
                size = room
            elif (size := pair(room)) is None and (size := triple(room)) is None:
                size = sizes[bisect_right(sizes, room) - 1]
            bins[-1].append(take(size))
            room -= size
    return bins


def fitness(bins: Bins, lengths: list[int], capacity: int) -> tuple[int, int]:
    """Larger is better: fewer bins, then fuller ones."""
    return -len(bins), sum(sum(lengths[i] for i in b) ** 2 for b in bins)


def crossover(
    host: Bins, guest: Bins, lengths: list[int], capacity: int, rng: random.Random
) -> Bins:
    """The host with well-filled bins of the guest, the fullest the likeliest."""
    spare = [capacity - sum(lengths[i] for i in b) for b in guest]
    most = rng.choice((0, 0, 1, 2, 4))
    injected = [b for b, s in zip(guest, spare, strict=True) if s <= most and rng.random() < 0.6]
    taken = {i for b in injected for i in b}
    kept, displaced = [], []
    for b in host:
        if taken.isdisjoint(b):
            kept.append(b.copy())
        else:
            displaced += [i for i in b if i not in taken]
    return settle(kept + [b.copy() for b in injected], displaced, lengths, capacity)


def settle(bins: Bins, displaced: list[int], lengths: list[int], capacity: int) -> Bins:
    displaced.sort(key=lambda i: (-lengths[i], i))
    return best_fit(bins, displaced, lengths, capacity)


def mutated(bins: Bins, lengths: list[int], capacity: int, rng: random.Random) -> Bins:
    """Some bins emptied, those with room among them, and their items put elsewhere."""
    fills = [sum(lengths[i] for i in b) for b in bins]
    out = {at for at, f in enumerate(fills) if f < capacity and rng.random() < 0.5}
    out |= set(rng.sample(range(len(bins)), min(len(bins), 1 + len(bins) // 20)))
    displaced = [i for at in out for i in bins[at]]
    rest = [b.copy() for at, b in enumerate(bins) if at not in out]
    # A little noise in the order gives other combinations than plain best fit.
    displaced.sort(key=lambda i: -lengths[i] * rng.uniform(0.8, 1.0))
    return best_fit(rest, displaced, lengths, capacity)


def evolve(
    lengths: list[int], capacity: int, population: list[Bins], seed: int, effort: Effort
) -> list[Bins]:
    """The best packings found from the given ones, the best first."""
    rng = random.Random(seed)
    order = sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))
    least = fewest_bins(lengths, capacity)
    population = population or [best_fit([], order, lengths, capacity)]
    while len(population) < effort.population and len(population[0]) > least:
        population.append(exact_fit(order, lengths, capacity, rng))
        population.sort(key=len)
    scored = sorted(
        ((fitness(p, lengths, capacity), at, p) for at, p in enumerate(population)), reverse=True
    )
    births = len(scored)
    for _ in range(effort.generations):
        if not lengths or len(scored[0][2]) <= least:
            break
        # Of two drawn at random the better one is a parent.
        host, guest = (min(rng.choices(range(len(scored)), k=2)) for _ in range(2))
        child = (
            crossover(scored[host][2], scored[guest][2], lengths, capacity, rng)
            if host != guest
            else mutated(scored[host][2], lengths, capacity, rng)
        )
        births += 1
        scored.append((fitness(child, lengths, capacity), births, child))
        scored.sort(reverse=True)
        # Two packings of equal fitness are most often the same one; keep one of them.
        scored = [s for at, s in enumerate(scored) if not at or s[0] != scored[at - 1][0]]
        scored = scored[: effort.population]
    return [p for _, _, p in scored[: effort.elites]]
