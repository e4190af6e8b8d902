"""Bin completion: packing lengths into as few sequences as the search finds.

Branch and bound over the counts of lengths. Every node takes the longest length
left and enumerates the undominated ways to fill the room around it, least waste
first: a filling is dominated if some of its pieces can be swapped for one piece at
least as long without overflow. A filling is used as often as the counts allow, then
once. A branch ends when its waste exceeds what an improvement may waste. Best-fit
solutions, of the whole and of what a node leaves over, are the incumbents.

The search stops when an incumbent meets the lower bound, which proves it optimal, or
after ``max_nodes`` nodes with the best incumbent. ``width`` bounds the fillings of a
node. Both bound search effort only: every piece is always placed. With None for both
the search is exact.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

from cartpulse.llm.bestfit import best_fit_decreasing
from cartpulse.llm.packing import CAPACITY, Filling, Plan

MAX_NODES = 300
WIDTH = 16
TRIED = 20


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences that any packing needs: by tokens, and with long pieces apart.

    For a cut k up to half the capacity, pieces over capacity - k and those over half
    the capacity get sequences of their own; what is left of k and more in between
    must fit in the room beside the latter.
    """
    lengths = sorted(counts)
    n_upto, sum_upto = [0], [0]  # over the lengths before each place
    for x in lengths:
        n_upto.append(n_upto[-1] + counts[x])
        sum_upto.append(sum_upto[-1] + x * counts[x])
    middle = bisect_right(lengths, capacity // 2)
    best = -(-sum_upto[-1] // capacity)
    for k in {0, *lengths[:middle]}:
        most = bisect_right(lengths, capacity - k)
        least = bisect_left(lengths, k)
        alone = n_upto[-1] - n_upto[most]
        halves = n_upto[most] - n_upto[middle]
        room = halves * capacity - (sum_upto[most] - sum_upto[middle])
        small = sum_upto[middle] - sum_upto[least]
        best = max(best, alone + halves + max(0, -(-(small - room) // capacity)))
    return best


def size(plan: Plan) -> int:
    return sum(times for _, times in plan)


def undominated(filling: list[int], room: int, left: dict[int, int]) -> bool:
    """Whether no part of ``filling`` can give way to one longer piece that is left."""
    slack = room - sum(filling)
    sums = {0: 0}  # sum of a part -> most pieces in one such part
    for length in filling:
        for total, n in list(sums.items()):
            sums[total + length] = max(sums.get(total + length, 0), n + 1)
    ordered = sorted(sums)
    for length, n in left.items():
        if n <= filling.count(length):
            continue
        at = bisect_left(ordered, length - slack)
        while at < len(ordered) and ordered[at] <= length:
            if ordered[at] < length or sums[ordered[at]] > 1:
                return False
            at += 1
    return True


def _reachable(lengths: list[int], left: dict[int, int], room: int) -> list[int]:
    """For every place, which sums up to ``room`` the lengths from there on make, as bits."""
    within = (1 << room + 1) - 1
    reach = [1]
    for x in reversed(lengths):
        bits, n, each = reach[-1], min(left[x], room // x), 1
        while n:  # 1, 2, 4 ... of them and the rest make any number
            times = min(each, n)
            bits |= bits << times * x & within
            n, each = n - times, 2 * each
        reach.append(bits)
    return reach[::-1]


def _making(
    total: int, at: int, lengths: list[int], left: dict[int, int], reach: list[int]
) -> Iterator[tuple[int, ...]]:
    """All multisets of the lengths from ``at`` on with this sum, long pieces first."""
    if not total:
        yield ()
        return
    for i in range(at, len(lengths)):
        if not reach[i] >> total & 1:
            return
        x = lengths[i]
        for n in range(min(left[x], total // x), 0, -1):
            rest = total - n * x
            if reach[i + 1] >> rest & 1:
                for others in _making(rest, i + 1, lengths, left, reach):
                    yield (x,) * n + others


def fillings(
    left: dict[int, int], room: int, most_waste: int, width: int | None
) -> list[tuple[int, ...]]:
    """Undominated fillings of a room that waste at most ``most_waste``, least waste first.

    All of them without a ``width``, else the first ``width`` among the first
    ``TRIED`` times as many that fill the room so far.
    """
    lengths = sorted((x for x, n in left.items() if n and x <= room), reverse=True)
    if room in left and left[room]:
        return [(room,)]  # fills the room, dominates all others
    reach = _reachable(lengths, left, room)
    found: list[tuple[int, ...]] = []
    tried = 0
    for waste in range(min(most_waste, room) + 1):
        if not reach[0] >> room - waste & 1:
            continue
        for chosen in _making(room - waste, 0, lengths, left, reach):
            tried += 1
            if undominated(list(chosen), room, left):
                found.append(chosen)
            if width is not None and (len(found) == width or tried == TRIED * width):
                return found
    return found


def _counted(lengths: tuple[int, ...]) -> Filling:
    return tuple((x, lengths.count(x)) for x in sorted(set(lengths), reverse=True))


def bin_completion(
    counts: dict[int, int],
    capacity: int = CAPACITY,
    max_nodes: int | None = MAX_NODES,
    width: int | None = WIDTH,
) -> Plan:
    """A plan of the fewest sequences found; the fewest there are without both bounds."""
    best = best_fit_decreasing(counts, capacity)
    bound = lower_bound(counts, capacity)
    total = sum(length * n for length, n in counts.items())
    nodes = 0
    stack = [(dict(counts), 0, [])]
    while stack and size(best) > bound and (max_nodes is None or nodes < max_nodes):
        left, used, plan = stack.pop()
        nodes += 1
        rest = sum(length * n for length, n in left.items())
        spent = used * capacity - (total - rest)  # wasted so far
        may_waste = (size(best) - 1) * capacity - total - spent
        if may_waste < 0 or used + lower_bound(left, capacity) >= size(best):
            continue
        incumbent = plan + best_fit_decreasing(left, capacity)
        if size(incumbent) < size(best):
            best = incumbent
            may_waste -= capacity
        if not left:
            continue
        longest = max(left)
        around = {x: n - (x == longest) for x, n in left.items()}
        ways = fillings(around, capacity - longest, may_waste, width)
        for way in reversed(ways):
            filling = _counted((longest, *way))
            often = min(left[x] // each for x, each in filling)
            for times in sorted({1, often}):
                after = dict(left)
                for x, each in filling:
                    after[x] -= each * times
                after = {x: n for x, n in after.items() if n}
                stack.append((after, used + times, [*plan, (filling, times)]))
    return best
