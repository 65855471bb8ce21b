"""Deep-shallow sorting of byte strings: multikey quicksort on the first bytes, blind tries for what still ties."""

from __future__ import annotations

#: Bytes that multikey quicksort looks at, and how many at once.
SHALLOW, STEP = 24, 8


def common(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (differ.bit_length() + 7) // 8


class _Node:
    __slots__ = ("children", "members", "skip")

    def __init__(self, skip: int, members: list[int] | None = None) -> None:
        self.skip, self.members, self.children = skip, members, {}


def _at(s: bytes, i: int) -> int:
    return s[i] if i < len(s) else -1


def blind_trie(strings: list[bytes], group: list[int]) -> list[int]:
    """group in the order of its strings. Nodes hold only the place where strings part; one comparison a string."""
    root = _Node(len(strings[group[0]]), [group[0]])
    for i in group[1:]:
        s, node = strings[i], root
        while node.members is None:  # blindly down, looking at branching bytes alone
            node = node.children.get(_at(s, node.skip)) or next(iter(node.children.values()))
        other = strings[node.members[0]]
        split = common(s, other)
        if split == len(s) == len(other):
            node.members.append(i)
            continue
        above, node = None, root
        while node.members is None and node.skip < split:
            above, node = node, node.children[_at(s, node.skip)]
        if node.members is None and node.skip == split:
            node.children[_at(s, split)] = _Node(len(s), [i])
            continue
        fork = _Node(split)
        fork.children = {_at(other, split): node, _at(s, split): _Node(len(s), [i])}
        if above is None:
            root = fork
        else:
            above.children[_at(s, above.skip)] = fork
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.members is not None:
            out += node.members
        else:
            stack += [node.children[k] for k in sorted(node.children, reverse=True)]
    return out


def deep_shallow(strings: list[bytes], shallow: int = SHALLOW) -> list[int]:
    """Indices of strings in their order; equal strings stand together."""
    out: list[int] = []
    stack = [(list(range(len(strings))), 0)]
    while stack:
        group, depth = stack.pop()
        if len(group) < 2:
            out += group
        elif depth >= shallow:
            out += blind_trie(strings, group)
        else:
            keys = [strings[i][depth : depth + STEP] for i in group]
            pivot = sorted((keys[0], keys[len(keys) // 2], keys[-1]))[1]
            parts = ([], [], [])
            for i, k in zip(group, keys, strict=True):
                parts[0 if k < pivot else 1 if k == pivot else 2].append(i)
            ended = len(pivot) < STEP  # equal in all that is left
            stack.append((parts[2], depth))
            if ended:
                stack.append((parts[0], depth))
                # what stands lower is sorted first; the ended ones follow it
                stack.insert(len(stack) - 1, (parts[1], shallow))
            else:
                stack.append((parts[1], depth + STEP))
                stack.append((parts[0], depth))
    return out
