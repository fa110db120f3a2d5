"""Union-free regular expressions over the parts of pages: inferred from steps, matched and written.

The content of an element is a chain of factors.  A factor is a part, or a group of parts that come in turns; it may be optional
(``?``), repeated (``+``) or both (``*``), and so may a part of a group be optional.  There are no alternatives.  A part stands once in a
chain, so that matching takes one look per part of a page.  A chain follows from the steps from part to part that pages
make, whose sets add up in any order: parts that can be reached from each other form a group, other parts keep the order of the steps,
and what a step passes over is optional.
"""

from __future__ import annotations

EDGE, TEXT = 0, 1  # where a content begins and ends; a run of text.  Other parts are digests of paths

CONTENT = "array<struct<members: array<struct<part: long, optional: boolean>>, optional: boolean, repeated: boolean>>"


def components(links: dict[int, list[int]]) -> list[list[int]]:
    """Parts that reach each other, in an order in which links lead forward (Tarjan)."""
    index, low, open_, out = {}, {}, {}, []
    for root in links:
        work = [] if root in index else [(root, iter(links[root]))]
        while work:
            node, rest = work[-1]
            if node not in index:
                index[node] = low[node] = len(index)
                open_[node] = True
            for after in rest:
                if after not in index:
                    work.append((after, iter(links[after])))
                    break
                if after in open_:
                    low[node] = min(low[node], index[after])
            else:
                work.pop()
                if work:
                    low[work[-1][0]] = min(low[work[-1][0]], low[node])
                if low[node] == index[node]:
                    group = []
                    while not group or group[-1] != node:
                        group.append(open_.popitem()[0])
                    out.append(group)
    return out[::-1]


def passed(count: int, jumps: list[tuple[int, int]]) -> list[bool]:
    """Which of ``count`` places lie inside one of the half-open ranges."""
    change = [0] * (count + 1)
    for start, end in jumps:
        if start < end:
            change[start] += 1
            change[end] -= 1
    found, depth = [], 0
    for place in range(count):
        depth += change[place]
        found.append(depth > 0)
    return found


def heaviest(group: list[int], links: dict[int, list[int]], weight: dict[tuple[int, int], int], entered: dict[int, int]) -> list[int]:
    """A group's parts, each followed by the one that most pages step to."""
    rest, last, turn = set(group), None, []
    while rest:
        nexts = [p for p in links[last] if p in rest] if turn else []
        last = min(nexts, key=lambda p: (-weight[last, p], p)) if nexts else min(rest, key=lambda p: (-entered[p], p))
        rest.remove(last)
        turn.append(last)
    return turn


def content(steps) -> list[tuple[list[tuple[int, bool]], bool, bool]]:
    """The chain of (members, optional, repeated) from (before, after, n): the steps of one element's pages and how many made them."""
    weight: dict[tuple[int, int], int] = {}
    for before, after, n in steps:
        weight[before, after] = weight.get((before, after), 0) + n
    links: dict[int, list[int]] = {part: [] for part in sorted({p for step in weight for p in step} - {EDGE})}
    for before, after in sorted(weight):
        if before != EDGE and after != EDGE:
            links[before].append(after)
    groups = components(links)
    at = {part: f for f, group in enumerate(groups) for part in group}
    entered = dict.fromkeys(links, 0)
    for (before, after), n in weight.items():
        if after != EDGE and at.get(before) != at[after]:
            entered[after] += n
    for f, group in enumerate(groups):  # a turn begins with the part that most pages enter; steps back to it end a turn
        if len(group) > 1:
            start, inside = min(group, key=lambda p: (-entered[p], p)), set(group)
            turn = components({p: [q for q in links[p] if q in inside and q != start] for p in [start, *sorted(inside - {start})]})
            groups[f] = [p for inner in turn for p in heaviest(inner, links, weight, entered)]
    spot = {part: (f, m) for f, group in enumerate(groups) for m, part in enumerate(group)}
    jumps, skips = [], [[] for _ in groups]
    for before, after in weight:
        f, m = spot.get(before, (-1, 0))
        g, k = spot.get(after, (len(groups), 0)) if after != EDGE else (len(groups), 0)
        jumps.append((f + 1, g))
        if f == g and m < k:
            skips[f].append((m + 1, k))
            continue
        if f >= 0:
            skips[f].append((m + 1, len(groups[f])))
        if g < len(groups):
            skips[g].append((0, k))
    optional = passed(len(groups), jumps)
    return [
        (list(zip(group, passed(len(group), skips[f]))), optional[f], len(group) > 1 or (group[0], group[0]) in weight)
        for f, group in enumerate(groups)
    ]


class Wrapper:
    """The expression of a host's pages: contents by path, texts that are fixed at a path, and lists of links.

    A repeated part that holds a list of links, and on no page more words than twice those in links, is such a list as a whole.
    """

    def __init__(self, parts: list[dict], fixed: set[tuple[int, int]], lists: list[int]):
        self.contents = {
            part["path"]: [
                ([(m["part"], m["optional"]) for m in factor["members"]], factor["optional"], factor["repeated"]) for factor in part["content"]
            ] for part in parts
        }
        self.texts = {part["path"]: part["texts"] or 0 for part in parts}
        self.spots = {
            path: {part: (f, m) for f, (members, _, _) in enumerate(chain) for m, (part, _) in enumerate(members)}
            for path, chain in self.contents.items()
        }
        self.fixed, self.lists, self.seen = fixed, set(lists), {}
        prose = {part["path"] for part in parts if part["prose"]}
        self.order, above, repeats = [], {}, set()  # paths from the root down
        stack = [0] if 0 in self.contents else []
        while stack:
            path = stack.pop()
            self.order.append(path)
            for members, _, repeated in self.contents[path]:
                for part, _ in members:
                    if part in self.contents:
                        above[part] = path
                        stack.append(part)
                        if repeated and part not in prose:
                            repeats.add(part)
        holding = set(self.lists)
        for path in reversed(self.order):
            if path in holding and path in above:
                holding.add(above[path])
        whole = set()
        for path in self.order:
            if path in repeats and path in holding or above.get(path) in whole:
                whole.add(path)
        self.lists |= whole

    def allows(self, path: int, before: int, after: int) -> bool:
        """Whether a part may follow another in the content of ``path``.  Whatever follows a part that the expression leaves out may."""
        spots = self.spots.get(path)
        if spots is None or after != EDGE and after not in spots:
            return False
        if before != EDGE and before not in spots:
            return True
        step = path, before, after
        if step not in self.seen:
            self.seen[step] = self._follows(*step)
        return self.seen[step]

    def _follows(self, path: int, before: int, after: int) -> bool:
        chain = self.contents[path]
        f, m = self.spots[path].get(before, (-1, 0))
        g, k = self.spots[path].get(after, (len(chain), 0))
        if f > g or f == g and not chain[f][2]:
            return False
        if f == g and m < k:
            return all(optional for _, optional in chain[f][0][m + 1:k])
        left = chain[f][0][m + 1:] if f >= 0 else []
        right = chain[g][0][:k] if g < len(chain) else []
        return all(optional for _, optional in left + right) and all(optional for _, optional, _ in chain[f + 1:g])

    def written(self, symbols: dict[int, str]) -> str:
        """The expression as a string: ``#`` is a slot, ``"..."`` the digest of a fixed text."""
        done: dict[int, str] = {}

        def marked(what: str, optional: bool, repeated: bool) -> str:
            return what + {(False, False): "", (True, False): "?", (False, True): "+", (True, True): "*"}[optional, repeated]

        def written(path: int, part: int) -> str:
            if part != TEXT:
                return symbols[part] + (f"({done[part]})" if done.get(part) else "")
            known = sorted(text for at, text in self.fixed if at == path)
            if not known:
                return "#"
            slot = self.texts[path] > len(known)
            if len(known) == 1 and not slot:
                return f'"{known[0]}"'
            return "(" + " ".join(f'"{text}"?' for text in known) + (" #?)" if slot else ")")

        for path in reversed(self.order):
            factors = []
            for members, optional, repeated in self.contents[path]:
                inner = " ".join(marked(written(path, part), skipped and len(members) > 1, False) for part, skipped in members)
                factors.append(marked(f"({inner})" if len(members) > 1 else inner, optional, repeated))
            done[path] = " ".join(factors)
        return done.get(0, "")
