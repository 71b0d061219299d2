"""Ropes of lines: texts as balanced trees of short leaves, cut and joined in a logarithmic number of steps.

Units are lines, each with its line feed; the last may lack one. A leaf holds whole lines, or a part of one that is longer than
LEAF_CHARS. Every node caches its code points and its units, a unit counted in the leaf that it begins in. Nodes never change:
cutting and joining share what stays the same.
"""

from __future__ import annotations

from collections.abc import Iterator

LEAF_CHARS = 2048  # code points of a leaf, at most


class Rope:
    """A leaf (text is set) or an inner node (left and right are set)."""

    __slots__ = ("text", "units", "chars", "height", "left", "right")

    def __init__(self, text: str | None, units: int, chars: int, left: Rope | None = None, right: Rope | None = None):
        self.text, self.units, self.chars, self.left, self.right = text, units, chars, left, right
        self.height = 0 if left is None else 1 + max(left.height, right.height)

    def leaves(self) -> Iterator[str]:
        todo = [self]
        while todo:
            r = todo.pop()
            if r.left is None:
                yield r.text
            else:
                todo += (r.right, r.left)

    def __str__(self) -> str:
        return "".join(self.leaves())


EMPTY = Rope("", 0, 0)


def leaf(text: str, units: int) -> Rope:
    return Rope(text, units, len(text)) if text else EMPTY


def _node(a: Rope, b: Rope) -> Rope:
    return Rope(None, a.units + b.units, a.chars + b.chars, a, b)


def _balance(a: Rope, b: Rope) -> Rope:
    """A node over a and b, of heights that differ by two at most; its sides' differ by one at most."""
    if a.height > b.height + 1:
        if a.left.height >= a.right.height:
            return _node(a.left, _node(a.right, b))
        return _node(_node(a.left, a.right.left), _node(a.right.right, b))
    if b.height > a.height + 1:
        if b.right.height >= b.left.height:
            return _node(_node(a, b.left), b.right)
        return _node(_node(a, b.left.left), _node(b.left.right, b.right))
    return _node(a, b)


def concat(a: Rope, b: Rope) -> Rope:
    """All of a, then all of b, in as many steps as their heights differ by."""
    if not a.chars:
        return b
    if not b.chars:
        return a
    if a.height > b.height + 1:
        return _balance(a.left, concat(a.right, b))
    if b.height > a.height + 1:
        return _balance(concat(a, b.left), b.right)
    return _node(a, b)


def build(text: str) -> Rope:
    """Leaves gather whole lines up to LEAF_CHARS; longer lines are cut up."""
    leaves, start, size = [], 0, len(text)
    while start < size:
        end = size if size - start <= LEAF_CHARS else text.rfind("\n", start, start + LEAF_CHARS) + 1
        if end > start:
            part = text[start:end]
            leaves.append(leaf(part, part.count("\n") + (part[-1] != "\n")))
        else:
            end = text.find("\n", start) + 1 or size
            leaves += [leaf(text[at : min(at + LEAF_CHARS, end)], int(at == start)) for at in range(start, end, LEAF_CHARS)]
        start = end

    def over(lo: int, hi: int) -> Rope:
        mid = (lo + hi) // 2
        return leaves[lo] if hi - lo == 1 else _node(over(lo, mid), over(mid, hi))

    return over(0, len(leaves)) if leaves else EMPTY


def split_units(r: Rope, k: int) -> tuple[Rope, Rope]:
    """The first k units, and the rest."""
    if k >= r.units:
        return r, EMPTY
    if r.left is None:
        at = 0
        for _ in range(k):
            at = r.text.find("\n", at) + 1
        return leaf(r.text[:at], k), leaf(r.text[at:], r.units - k)
    if k < r.left.units:
        a, b = split_units(r.left, k)
        return a, concat(b, r.right)
    a, b = split_units(r.right, k - r.left.units)
    return concat(r.left, a), b


def split_chars(r: Rope, k: int) -> tuple[Rope, Rope]:
    """The first k code points, and the rest. The second part of a line that is cut counts no unit."""
    if k <= 0:
        return EMPTY, r
    if k >= r.chars:
        return r, EMPTY
    if r.left is None:
        n = min(r.units, 1 + r.text.count("\n", 0, k - 1))
        begins = k if r.text[k - 1] == "\n" else r.text.find("\n", k) + 1 or r.chars
        return leaf(r.text[:k], n), concat(leaf(r.text[k:begins], 0), leaf(r.text[begins:], r.units - n))
    if k <= r.left.chars:
        a, b = split_chars(r.left, k)
        return a, concat(b, r.right)
    a, b = split_chars(r.right, k - r.left.chars)
    return concat(r.left, a), b


def find(r: Rope, mark: str) -> int:
    """Code points before the first occurrence of mark, also across leaves; -1 where there is none."""
    before, tail = 0, ""
    for part in r.leaves():
        seen = tail + part
        at = seen.find(mark)
        if at >= 0:
            return before - len(tail) + at
        before += len(part)
        tail = seen[1 - len(mark) :] if len(mark) > 1 else ""
    return -1
