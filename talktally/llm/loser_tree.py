"""Merging of many sorted runs by a tree of losers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator




_END = (1,)


def merged(runs: Iterable[Iterable[tuple]]) -> Iterator[tuple]:
    """All items of sorted runs in order; of equal ones those of earlier runs come first.

    Each inner node holds the run that lost there, so that the next item costs one match
    on each level of the path from its run's leaf to the root.
    """
    sources = [iter(run) for run in runs]
    count = len(sources)
    if not count:
        return

    def pull(at: int) -> tuple:
        item = next(sources[at], None)
        return _END if item is None else (0, item, at)

    heads = [pull(at) for at in range(count)]
    losers = [0] * count

    def play(node: int) -> int:
        """The winner of the matches below a node; leaves follow the inner nodes."""
        if node >= count:
            return node - count
        left, right = play(2 * node), play(2 * node + 1)
        winner, losers[node] = (right, left) if heads[right] < heads[left] else (left, right)
        return winner

    winner = play(1) if count > 1 else 0
    while heads[winner] is not _END:
        yield heads[winner][1]
        heads[winner] = pull(winner)
        node = (winner + count) // 2
        while node:
            if heads[losers[node]] < heads[winner]:
                losers[node], winner = winner, losers[node]
            node //= 2
