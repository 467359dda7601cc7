"""Deep-shallow sorting of many short strings in groups.

Shallow: multikey quicksort with eight bytes as one character. Each pass splits
every range of strings that are still equal by their next character; ranges of one
string are done. Deep: what is still together after ``SHALLOW`` passes has a long
common prefix. Each such range is ordered by a blind trie, which keeps of its
strings only the places where they branch: a string goes down by the branching
bytes alone, is compared once with the string it arrives at, and is hung where the
two first differ.
"""

from __future__ import annotations

import numpy as np

SHALLOW = 3


def padded(strings: list[bytes]) -> np.ndarray:
    """The strings as rows of bytes, filled up with zeros to a multiple of eight."""
    sizes = np.fromiter(map(len, strings), np.int64, len(strings))
    width = max(8, -(-int(sizes.max(initial=0)) // 8) * 8)
    out = np.zeros((len(strings), width), np.uint8)
    out[np.arange(width) < sizes[:, None]] = np.frombuffer(b"".join(strings), np.uint8)
    return out


def equal_bytes(differ: np.ndarray) -> np.ndarray:
    """How many leading bytes of two big-endian words are equal, given their exclusive-or."""
    equal = np.zeros(len(differ), np.int64)
    for kept in range(1, 9):
        equal += (differ >> np.uint64(64 - 8 * kept)) == 0
    return equal


class BlindTrie:
    """Orders strings of one length. A node is [branching place, {byte: node or leaf}]; a leaf a list of rows."""

    def __init__(self, strings: list[bytes]) -> None:
        self.strings = strings
        self.root: list = [0]
        for row in range(1, len(strings)):
            self._insert(row)

    def _insert(self, row: int) -> None:
        string, node = self.strings[row], self.root
        path = []
        while isinstance(node[-1], dict):
            path.append(node)
            # Any leaf below will do for the comparison if the byte is new here.
            node = node[1].get(string[node[0]]) or next(iter(node[1].values()))
        other = self.strings[node[0]]
        if other == string:
            node.append(row)
            return
        size = len(string)
        differ = int.from_bytes(string) ^ int.from_bytes(other)
        place = size - (differ.bit_length() + 7) // 8
        above, below = None, self.root
        for step in path:
            if step[0] >= place:
                break
            above, below = step, step[1][string[step[0]]] if string[step[0]] in step[1] else None
        if above is None:
            below = self.root
        if below is not None and isinstance(below[-1], dict) and below[0] == place:
            below[1][string[place]] = [row]
            return
        branch = [place, {other[place]: below, string[place]: [row]}]
        if above is None:
            self.root = branch
        else:
            above[1][string[above[0]]] = branch

    def order(self) -> tuple[list[int], list[int]]:
        """Rows in order, and how many leading bytes each shares with the row before (the first: none)."""
        rows: list[int] = []
        shared: list[int] = []
        size = len(self.strings[0])
        stack = [(self.root, 0)]
        while stack:
            node, common = stack.pop()
            if isinstance(node[-1], dict):
                below = sorted(node[1].items())
                stack += [(child, node[0]) for _, child in below[:0:-1]]
                stack.append((below[0][1], common))
            else:
                rows += node
                shared += [common, *[size] * (len(node) - 1)]
        return rows, shared


def deep_shallow_order(strings: list[bytes], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The order of the strings within ascending groups, and the common prefixes.

    ``shared[i]`` is the number of leading bytes that the i-th string in order has in
    common with the one before it, -1 where a group starts. Strings count as filled
    up with zeros to one length.
    """
    text = padded(strings)
    words = text.view(">u8").astype(np.uint64)
    order = np.argsort(group, kind="stable")
    shared = np.full(len(strings), -1, np.int64)
    fresh = np.ones(len(strings), bool)
    fresh[1:] = group[order][1:] != group[order][:-1]
    for level in range(min(SHALLOW, words.shape[1])):
        ranges = np.cumsum(fresh) - 1
        alone = np.bincount(ranges)[ranges] == 1
        active = np.flatnonzero(~alone)
        if len(active) == 0:
            break
        word = words[order[active], level]
        turn = np.lexsort((word, ranges[active]))
        order[active] = order[active][turn]
        word = word[turn]
        # A range stays in its places, so neighbours in the active list are neighbours in order.
        inner = ~fresh[active[1:]]
        splits = inner & (word[1:] != word[:-1])
        at = active[1:][splits]
        shared[at] = 8 * level + equal_bytes(word[1:][splits] ^ word[:-1][splits])
        fresh[at] = True
    depth = min(SHALLOW, words.shape[1]) * 8
    starts = np.flatnonzero(fresh)
    ends = np.append(starts[1:], len(strings))
    for start, end in zip(starts[ends - starts > 1].tolist(), ends[ends - starts > 1].tolist()):
        rows = order[start:end]
        if depth == text.shape[1]:
            shared[start + 1:end] = depth
            continue
        tails = [tail.tobytes() for tail in text[rows, depth:]]
        turn, common = BlindTrie(tails).order()
        order[start:end] = rows[turn]
        shared[start + 1:end] = np.array(common[1:]) + depth
    return order, shared
