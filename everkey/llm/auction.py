"""Cheapest repairs of a row of turns by the auction algorithm for shortest paths.

A row of turns is a lattice: a node for each place between turns and each state of the pattern, and one arc for each
edit.  Prices start at a bound from below (what blank, repeated and cut-off turns cost at least) and obey price(i) <= cost
+ price(j) on every arc.  A path grows from its origin: if all arcs of its last node cost more than the node's price
says, the price rises to the cheapest and the path contracts, else it extends along the cheapest arc.  When it reaches a
node whose price is settled, the prices along the path are the exact costs to the end.  Arcs with price(i) = cost +
price(j) are tight; of these the least letter is followed.  A price that is still too low may make an arc look tight, so
the node behind it is settled before its arc is taken.
"""

from __future__ import annotations

INF = float("inf")
#: Fixed values of the contract: costs of the edits, and of a cut-off turn that stays.
REROLE, DELETE, INSERT, CUT = 1, 2, 5, 5
#: States: nothing yet, after system, after user, after assistant.
NEW, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
INITIAL = {NEW: "", SYSTEM: "s", USER: "u", ASSISTANT: "a"}
#: The turn that may come next in each state, beside system at the start.
NEXT = {NEW: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Costs of ending in a state: a whole conversation is empty or ends with the assistant.
WHOLE = (0, None, None, 0)


class Lattice:
    """``turns`` are (initial, must go, cut off); ``ends`` the cost that follows each last state, None where it can't end."""

    def __init__(self, turns: list[tuple[str, bool, bool]], ends: tuple):
        self.turns = turns
        self.ends = ends
        n = len(turns)
        able = {s for s in range(STATES) if ends[s] is not None}
        # States that some end can be reached from: only a system turn leads to SYSTEM, and nothing leads back to NEW.
        self.open = set(range(STATES)) if able & {USER, ASSISTANT} else {NEW, SYSTEM} if SYSTEM in able else able
        low = [0] * (n + 1)
        low[n] = min((e for e in ends if e is not None), default=0)
        for i in range(n - 1, -1, -1):
            low[i] = low[i + 1] + (DELETE if turns[i][1] or turns[i][2] else 0)
        self.price = [low[i] for i in range(n + 1) for _ in range(STATES)] + [0]
        self.exact = [False] * (STATES * (n + 1)) + [True]

    def arcs(self, node: int) -> list[tuple[str, int, int]]:
        """(letter, cost, node) of each edit at a node; the last node of all is the end, its letter empty."""
        i, state = divmod(node, STATES)
        then = NEXT[state]
        out = []
        if i < len(self.turns):
            initial, goes, cut = self.turns[i]
            below = STATES * (i + 1)
            out.append(("D", DELETE, below + state))
            if not goes:
                extra = CUT if cut else 0
                if initial == INITIAL[then]:
                    out.append(("K", extra, below + then))
                elif state == NEW and initial == "s":
                    out.append(("K", extra, below + SYSTEM))
                out.append(("R", REROLE + extra, below + then))
        elif self.ends[state] is not None:
            out.append(("", self.ends[state], STATES * (len(self.turns) + 1)))
        out.append(("I", INSERT, STATES * i + then))
        last = STATES * (len(self.turns) + 1)
        return [a for a in out if a[2] == last or a[2] % STATES in self.open]

    def settle(self, origin: int) -> float:
        """The exact cost from a node to the end, infinite if there is no way."""
        price, exact = self.price, self.exact
        path = [origin]
        while not exact[path[-1]]:
            node = path[-1]
            best, to = INF, -1
            for _, cost, j in self.arcs(node):
                if cost + price[j] < best:
                    best, to = cost + price[j], j
            if price[node] < best:
                price[node] = best
                if best == INF:
                    exact[node] = True
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        if price[path[-1]] < INF:
            for node in path:
                exact[node] = True
        return price[origin]

    def trace(self, state: int) -> tuple[str, int]:
        """Letters of the cheapest edits from a state on, the least in ASCII order, and the state they end in."""
        node, letters = state, []
        self.settle(node)
        while True:
            for letter, cost, j in sorted(self.arcs(node)):
                if self.price[node] == cost + self.price[j] and self.settle(j) + cost == self.price[node]:
                    break
            if not letter:
                return "".join(letters), node % STATES
            letters.append(letter)
            node = j


def transitions(turns: list[tuple[str, bool, bool]]) -> list[list]:
    """Cost of the cheapest edits from each state to each state, None where there are none."""
    out: list[list] = [[None] * STATES for _ in range(STATES)]
    for end in range(STATES):
        lattice = Lattice(turns, tuple(0 if s == end else None for s in range(STATES)))
        for start in range(STATES):
            if start in lattice.open:
                cost = lattice.settle(start)
                out[start][end] = None if cost == INF else int(cost)
    return out


class Chain(Lattice):
    """A lattice of stretches, each given by its ``transitions``, that ends like a whole conversation."""

    def __init__(self, stretches: list[list[list]], ends: tuple = WHOLE):
        self.turns, self.ends = stretches, ends
        n = len(stretches)
        low = [0] * (n + 1)
        for i in range(n - 1, -1, -1):
            low[i] = low[i + 1] + min(c for row in stretches[i] for c in row if c is not None)
        self.price = [low[i] for i in range(n + 1) for _ in range(STATES)] + [0]
        self.exact = [False] * (STATES * (n + 1)) + [True]

    def arcs(self, node: int) -> list[tuple[str, int, int]]:
        i, state = divmod(node, STATES)
        if i == len(self.turns):
            return [] if self.ends[state] is None else [("", self.ends[state], STATES * (i + 1))]
        return [("", cost, STATES * (i + 1) + end) for end, cost in enumerate(self.turns[i][state]) if cost is not None]

    def costs_after(self) -> list[tuple]:
        """For each stretch, the exact cost that follows each state at its end."""
        n = len(self.turns)
        for i in range(n, 0, -1):
            for state in range(STATES):
                self.settle(STATES * i + state)
        return [tuple(None if self.price[STATES * (i + 1) + s] == INF else int(self.price[STATES * (i + 1) + s]) for s in range(STATES)) for i in range(n)]


def repaired(turns: list[tuple[str, str]], letters: str, state: int = NEW) -> list[tuple[str, str]]:
    """Role and text of the turns after the edits."""
    out, i = [], 0
    for letter in letters:
        if letter != "I":
            role, text = turns[i]
            i += 1
        if letter == "D":
            continue
        if letter == "K" and state == NEW and role[:1] == "s":
            state = SYSTEM
        else:
            state = NEXT[state]
            role, text = (role, text) if letter == "K" else (ROLE[state], "" if letter == "I" else text)
        out.append((role, text))
    return out
