"""Deep-shallow string sorting.

Strings that share their beginnings are first ordered by multikey quicksort to a shallow depth: all groups at once are split on their
next bytes, and what stands alone leaves. Groups that still hang together have long common prefixes; their equal members are
recognised by comparing each with the group's first, and groups that differ are split further. What hangs together still at the depth
DEEP goes through a blind trie (a Patricia trie that compares only at its branching positions on the way down and verifies once at the
leaf): a trie costs Python steps for each string, so it pays only where prefixes are long.
"""

from __future__ import annotations

import numpy as np

from .common import U64

SHALLOW, DEEP = 24, 96
#: Where the number of a group fits into 24 bits, it stands with five bytes in one number.
STEP, GROUP_BITS = 5, 24
_bytes_kept = np.array([(0xFFFFFFFFFFFFFFFF << (8 * (8 - n))) & 0xFFFFFFFFFFFFFFFF for n in range(9)], U64)


def word(buffer: np.ndarray, start: np.ndarray, length: np.ndarray, depth: int) -> np.ndarray:
    """Eight bytes at `depth` of every string as a big-endian number, zeros after its end. The buffer has 8 spare bytes."""
    view = np.ndarray((len(buffer) - 7,), "<u8", buffer, strides=(1,))
    room = np.clip(length - depth, 0, 8)
    at = np.where(room > 0, start + depth, 0)
    return view[at].byteswap() & _bytes_kept[room]


class Blind:
    """A blind trie over byte strings; equal strings share a leaf."""

    def __init__(self) -> None:
        self.root: list | None = None

    def add(self, text: bytes, item: int) -> None:
        """Nodes are [position, {byte: node}] and leaves [-1, text, items]; byte -1 means that a string ends."""
        leaf = [-1, text, [item]]
        if self.root is None:
            self.root = leaf
            return
        node = self.root
        while node[0] >= 0:
            key = text[node[0]] if node[0] < len(text) else -1
            node = node[1].get(key) or next(iter(node[1].values()))
        other = node[1]
        if other == text:
            node[2].append(item)
            return
        n = min(len(text), len(other))
        differ = int.from_bytes(text[:n]) ^ int.from_bytes(other[:n])
        at = n - (differ.bit_length() + 7) // 8
        holder, key, node = None, None, self.root
        while 0 <= node[0] < at:
            holder, key = node, text[node[0]] if node[0] < len(text) else -1
            node = node[1][key]
        mine = text[at] if at < len(text) else -1
        if node[0] == at:
            node[1][mine] = leaf
            return
        fork = [at, {mine: leaf, (other[at] if at < len(other) else -1): node}]
        if holder is None:
            self.root = fork
        else:
            holder[1][key] = fork

    def leaves(self) -> list[list[int]]:
        """Items of the equal strings, in string order."""
        out, stack = [], [self.root] if self.root else []
        while stack:
            node = stack.pop()
            if node[0] < 0:
                out.append(node[2])
            else:
                stack.extend(node[1][k] for k in sorted(node[1], reverse=True))
        return out


def sort(buffer: np.ndarray, start: np.ndarray, length: np.ndarray, lead: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings (by `lead`, then bytes, then length), and for each in that order whether it differs from the one before."""
    n = len(start)
    if lead is None:
        order, new = np.arange(n), np.zeros(n, bool)
    else:
        order = np.argsort(lead, kind="stable")
        new = np.zeros(n, bool)
        new[1:] = lead[order][1:] != lead[order][:-1]
    if not n:
        return order, new
    new[0] = True
    open_, depth = _split(buffer, start, length, order, new, np.arange(n), 0, SHALLOW)
    if not len(open_):
        return order, new
    group = np.cumsum(new) - 1
    items = order[open_]
    first = order[np.flatnonzero(new)][group[open_]]
    same = length[items] == length[first]
    check = np.flatnonzero(same & (items != first))
    for d in range(depth, int(length[items].max()), 8):
        check = check[length[items[check]] > d]
        if not len(check):
            break
        a, b = items[check], first[check]
        differ = word(buffer, start[a], length[a], d) != word(buffer, start[b], length[b], d)
        same[check[differ]] = False
        check = check[~differ]
    mixed = np.zeros(int(group[-1]) + 1, bool)
    mixed[group[open_[~same]]] = True
    open_ = open_[mixed[group[open_]]]
    if not len(open_):
        return order, new
    open_, depth = _split(buffer, start, length, order, new, open_, depth, DEEP)
    if len(open_):
        group = np.cumsum(new) - 1
        deep = np.zeros(int(group[-1]) + 1, bool)
        long = length[order[open_]]
        deep[group[open_[long > depth]]] = True
        deep[group[open_[long != long[np.searchsorted(open_, np.flatnonzero(new)[group[open_]])]]]] = True
        _tries(buffer, start, length, order, new, np.flatnonzero(deep))
    return order, new


def _split(buffer: np.ndarray, start: np.ndarray, length: np.ndarray, order: np.ndarray, new: np.ndarray, open_: np.ndarray, depth: int, limit: int) -> tuple[np.ndarray, int]:
    """Splits the groups at the places `open_` of the order on the bytes from depth to limit, in place; which places are in groups of several strings still, and the depth reached."""
    if not len(open_):
        return open_, depth
    longest = int(length[order[open_]].max())
    while True:
        # whole groups are open, so a group is a run of open places
        edge = new[open_]
        alone = edge & np.append(edge[1:], True)
        open_ = open_[~alone]
        if not len(open_) or depth >= min(limit, longest):
            return open_, depth
        own = np.cumsum(new[open_], dtype=np.int64) - 1
        items = order[open_]
        key = word(buffer, start[items], length[items], depth)
        if int(own[-1]) >> GROUP_BITS:
            by = np.lexsort((key, own))
            key, own = key[by], own[by]
            cut = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
            depth += 8
        else:
            key = (key >> U64(8 * (8 - STEP))) | (own.astype(U64) << U64(8 * STEP))
            by = np.argsort(key)
            key = key[by]
            cut = key[1:] != key[:-1]
            depth += STEP
        order[open_] = items[by]
        new[open_[1:]] |= cut


def _tries(buffer: np.ndarray, start: np.ndarray, length: np.ndarray, order: np.ndarray, new: np.ndarray, groups: np.ndarray) -> None:
    """Orders the members of the groups by blind tries, in place."""
    data = buffer.tobytes() if len(groups) else b""
    edges = np.append(np.flatnonzero(new), len(order))
    for g in groups.tolist():
        a, b = int(edges[g]), int(edges[g + 1])
        trie = Blind()
        for item in order[a:b].tolist():
            s = int(start[item])
            trie.add(data[s : s + int(length[item])], item)
        at = a
        for leaf in trie.leaves():
            order[at : at + len(leaf)] = leaf
            new[at] = True
            new[at + 1 : at + len(leaf)] = False
            at += len(leaf)
