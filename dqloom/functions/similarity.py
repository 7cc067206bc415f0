"""Weighted similarity of names, 0 to 100, by longest common subsequences.

ratio is 200 * LCS / (len a + len b). Token scores sort the words or compare their shared part with the
rest; partial scores slide the shorter text over the longer one. For texts of similar length the best of ratio and 0.95
times the token score counts; beyond a length ratio of 1.5 partial scores, scaled by 0.9 (0.6 beyond 8), count as well.
"""

from __future__ import annotations

from collections.abc import Iterable

TOKEN_SCALE, PARTIAL_SCALE, LONG_PARTIAL_SCALE = 0.95, 0.9, 0.6
PARTIAL_FROM, LONG_FROM = 1.5, 8.0


def lcs_length(a: str, b: str) -> int:
    """Bit-parallel longest common subsequence: one big integer holds a row of the table."""
    if len(a) > len(b):
        a, b = b, a
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        match = row & places.get(c, 0)
        row = ((row + match) | (row - match)) & full
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    total = len(a) + len(b)
    return 200.0 * lcs_length(a, b) / total if total else 100.0


def partial_ratio(a: str, b: str) -> float:
    """The best ratio of the shorter text (of equally long ones, either) with a stretch of its length, also where it hangs over an end."""
    if len(a) > len(b):
        a, b = b, a
    if not a:
        return 0.0
    return max(_slide(a, b), _slide(b, a)) if len(a) == len(b) else _slide(a, b)


def _slide(a: str, b: str) -> float:
    n = len(a)
    letters = set(a)
    best = 0.0
    for i in range(1 - n, len(b)):
        part = b[max(0, i) : i + n]
        # A stretch that starts or ends with a letter that a lacks is never better than the one beside it.
        edge = part[-1] if i <= 0 else part[0]
        if edge in letters:
            best = max(best, ratio(a, part))
            if best == 100.0:
                break
    return best


def _token_sets(a: str, b: str) -> tuple[str, str, str]:
    x, y = set(a.split()), set(b.split())
    return tuple(" ".join(sorted(s)) for s in (x & y, x - y, y - x))


def token_ratio(a: str, b: str) -> float:
    """The better of the ratio of sorted words and that of the words' sets."""
    best = ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))
    both, rest_a, rest_b = _token_sets(a, b)
    if not (a.split() and b.split()):
        return 0.0
    if both:
        if not rest_a or not rest_b:
            return 100.0
        left, right = f"{both} {rest_a}", f"{both} {rest_b}"
        best = max(best, ratio(both, left), ratio(both, right), ratio(left, right))
    else:
        best = max(best, ratio(rest_a, rest_b))
    return best


def partial_token_ratio(a: str, b: str) -> float:
    if not (a.split() and b.split()):
        return 0.0
    both, rest_a, rest_b = _token_sets(a, b)
    if both:
        return 100.0
    return max(partial_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))), partial_ratio(rest_a, rest_b))


def weighted_ratio(a: str, b: str) -> float:
    """0 where either text is empty."""
    if not a or not b:
        return 0.0
    lengths = max(len(a), len(b)) / min(len(a), len(b))
    best = ratio(a, b)
    if lengths < PARTIAL_FROM:
        return max(best, TOKEN_SCALE * token_ratio(a, b))
    scale = PARTIAL_SCALE if lengths <= LONG_FROM else LONG_PARTIAL_SCALE
    return max(best, scale * partial_ratio(a, b), TOKEN_SCALE * scale * partial_token_ratio(a, b))


def upper_bound(a: str, b: str) -> float:
    """No weighted_ratio exceeds this; cheap, from lengths alone."""
    if not a or not b:
        return 0.0
    lengths = max(len(a), len(b)) / min(len(a), len(b))
    if lengths < PARTIAL_FROM:
        return 100.0
    short = 200.0 / (1 + lengths)
    return max(short, 100.0 * (PARTIAL_SCALE if lengths <= LONG_FROM else LONG_PARTIAL_SCALE))


def top_matches(label: str, names: Iterable[str], k: int = 3, cutoff: float = 0.0) -> list[tuple[int, float]]:
    """Positions and scores of the k best names; equal scores keep the names' order."""
    found: list[tuple[float, int]] = []
    for i, name in enumerate(names):
        floor = found[-1][0] if len(found) == k else cutoff
        if upper_bound(label, name) < max(floor, cutoff) or (len(found) == k and upper_bound(label, name) <= floor):
            continue
        score = weighted_ratio(label, name)
        if score >= cutoff and (len(found) < k or score > floor):
            found.append((score, i))
            found.sort(key=lambda x: (-x[0], x[1]))
            del found[k:]
    return [(i, s) for s, i in found]
