"""Adaptive radix tree over byte keys: nodes that grow with their children, compressed paths.

A node holds the bytes that lead to it from its parent (its path), its children by next
byte, and what was put in under exactly its key. A node starts with room for 4 children and
grows to 16, 48 and 256; an empty layout is the leaf. Keys may be prefixes of each other.
Values are combined by `merge` when a key is put in again.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator


class Few:
    """Up to 4, then up to 16 children: their bytes in order, and the children beside them."""

    __slots__ = ("room", "bytes", "nodes")

    def __init__(self, room: int = 4):
        self.room, self.bytes, self.nodes = room, bytearray(), []

    def get(self, byte: int) -> Node | None:
        i = bisect_left(self.bytes, byte)
        return self.nodes[i] if i < len(self.bytes) and self.bytes[i] == byte else None

    def put(self, byte: int, node: Node) -> Few | Indexed:
        i = bisect_left(self.bytes, byte)
        if i < len(self.bytes) and self.bytes[i] == byte:
            self.nodes[i] = node
            return self
        if len(self.bytes) == self.room:
            larger = Few(16) if self.room == 4 else Indexed()
            for b, n in self.items():
                larger.put(b, n)
            return larger.put(byte, node)
        self.bytes.insert(i, byte)
        self.nodes.insert(i, node)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.bytes, self.nodes)


class Indexed:
    """Up to 48 children: a place for each byte, 0 for none."""

    __slots__ = ("places", "nodes")

    def __init__(self):
        self.places, self.nodes = bytearray(256), []

    def get(self, byte: int) -> Node | None:
        place = self.places[byte]
        return self.nodes[place - 1] if place else None

    def put(self, byte: int, node: Node) -> Indexed | Direct:
        if place := self.places[byte]:
            self.nodes[place - 1] = node
            return self
        if len(self.nodes) == 48:
            larger = Direct()
            for b, n in self.items():
                larger.put(b, n)
            return larger.put(byte, node)
        self.nodes.append(node)
        self.places[byte] = len(self.nodes)
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, self.nodes[p - 1]) for b, p in enumerate(self.places) if p)


class Direct:
    """A child for each byte."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> Direct:
        self.nodes[byte] = node
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


class Node:
    __slots__ = ("path", "children", "value")

    def __init__(self, path: bytes, value=None):
        self.path, self.children, self.value = path, None, value

    def hang(self, node: Node) -> None:
        """Make `node`, whose path begins with its own byte, a child."""
        self.children = (self.children or Few()).put(node.path[0], node)

    def child(self, byte: int) -> Node | None:
        return self.children.get(byte) if self.children else None


def shared(a: bytes, b: bytes) -> int:
    """Length of the common beginning."""
    most = min(len(a), len(b))
    if a[:most] == b[:most]:
        return most
    low, high = 0, most - 1  # a[:low] is shared, a[:high + 1] is not
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return low


class Tree:
    def __init__(self, merge: Callable):
        self.root, self.merge = Node(b""), merge

    def put(self, key: bytes, value) -> None:
        above, node, at = None, self.root, 0
        while True:
            common = shared(node.path, key[at : at + len(node.path)])
            if common < len(node.path):  # the key leaves this node's path: a node goes in between
                between = Node(node.path[:common])
                node.path = node.path[common:]
                between.hang(node)
                above.hang(between)
                node = between
            at += common
            if at == len(key):
                node.value = value if node.value is None else self.merge(node.value, value)
                return
            below = node.child(key[at])
            if below is None:
                node.hang(Node(key[at:], value))
                return
            above, node = node, below

    def nodes(self) -> Iterator[tuple[int, int | None, bytes, bytes, object]]:
        """(number, number of the parent, key before the path, path, what the subtree holds together), parents first.

        Two walks without recursion, as paths may be as many as a key has bytes.
        """
        order: list[tuple[Node, int | None, bytes]] = []
        stack: list[tuple[Node, int | None, bytes]] = [(self.root, None, b"")]
        while stack:
            node, above, before = stack.pop()
            if node.children:
                key = before + node.path
                stack += [(child, len(order), key) for _, child in node.children.items()]
            order.append((node, above, before))
        held = [node.value for node, _, _ in order]
        for number in range(len(order) - 1, 0, -1):
            above = order[number][1]
            held[above] = held[number] if held[above] is None else self.merge(held[above], held[number])
        for number, (node, above, before) in enumerate(order):
            if held[number] is not None:
                yield number, above, before, node.path, held[number]
