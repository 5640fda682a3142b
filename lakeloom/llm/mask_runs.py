"""Runs of masks in a token, of any length, read as letters under a character model.

How a run is read has two parts that do not depend on each other: which of its characters are
letters, and which letters they are.  The first only matters for what the other characters
cost (a repeat, if the last letter was read from the same character, or a dropped separator) and what it leaves as the last
character (``spent``, a table over the number of letters); the second only for the character model's scores, which
depend on the number of letters alone (``steps``).  Each step is one pass over the model's counts, not over all
states times letters: a context that never had a letter scores it as its shorter end does,
so a context needs its own letters and the best of the shorter one.

Every letter costs more than a repeat, and scores are logarithms, so only so many letters are tried as could still win.
"""

from __future__ import annotations

import numpy as np

#: Steps, and tables of runs at the end of a token, that are kept for the next token.
KEPT = 64


class MaskRuns:
    """States are the model's contexts: three letters, or fewer where no word has more (``CharModel.state``)."""

    def __init__(self, lm, mask_cost: float, drop_cost: float, repeat_cost: float):
        self.lm, self.mask_cost, self.drop_cost, self.repeat_cost = lm, mask_cost, drop_cost, repeat_cost
        # nodes by order: contexts of 1, 2 and 3 characters; those of order 1 that are no letter (^) are no state
        nodes = [[], sorted({*lm.letters, *(c for c, n in lm.ctx[1].items() if n)}), sorted(c for c, n in lm.ctx[2].items() if n),
                 sorted(c for c, n in lm.ctx[3].items() if n)]
        self.place = [{c: i for i, c in enumerate(n)} for n in nodes]
        self.letter = {x: i for i, x in enumerate(lm.letters)}
        self.sizes = [len(n) for n in nodes]
        base = np.cumsum([0, *self.sizes[1:3]])  # numbers of the states of order 1, 2, 3
        self.base = [0, *base.tolist()]
        self.names = [f"\0\0{c}" for c in nodes[1]] + [f"\0{c}" for c in nodes[2]] + nodes[3]
        self.number = {c: i for i, c in enumerate(self.names)}
        #: A context that ends with a character no word has: every letter scores as after nothing at all.
        self.blank = len(self.names)
        self.known = np.array([*(c[-1] in lm.known for c in self.names), False])
        self.end = np.array([*(lm.score(c, "$") for c in self.names), lm.score("\0\0\0", "$")])
        #: Contexts that letters alone lead to.
        self.free = np.flatnonzero(np.array([*("^" not in c for c in self.names), False]))
        ground = 1.0 / (len(lm.letters) + 2)
        total, kinds = lm.ctx[0][""], lm.kinds[0][""]
        p0 = np.array([(lm.grams[0][x] + kinds * ground) / (total + kinds) if total else ground for x in lm.letters])
        self.log0, self.after0 = np.log(p0), np.array([self.base[1] + self.place[1][x] for x in lm.letters], np.int64)
        self.back, self.loss, self.seen = [None], [None], [None]
        p_of: list = [None, {}, {}, {}]
        for order in (1, 2, 3):
            tot = np.array([lm.ctx[order][c] for c in nodes[order]], float)
            kind = np.array([lm.kinds[order][c] for c in nodes[order]], float)
            some = tot > 0
            self.loss.append(np.log(np.where(some, kind / np.where(some, tot + kind, 1), 1.0)))
            # the shorter context, or 0 for all letters
            self.back.append(np.array([self.place[order - 1][c[1:]] if order > 1 else 0 for c in nodes[order]], np.int64))
            entries = []
            for gram, n in lm.grams[order].items():
                if (x := self.letter.get(gram[-1])) is None:
                    continue
                c = self.place[order][gram[:-1]]
                lower = p_of[order - 1].get(gram[1:]) if order > 1 else p0[x]
                p = (n + kind[c] * lower) / (tot[c] + kind[c])
                p_of[order][gram] = p
                to = self.base[3] + self.place[3][gram[1:]] if order == 3 else (
                    self.base[3] + self.place[3][gram] if order == 2 else self.base[2] + self.place[2][gram])
                entries.append((c, x, p, to))
            entries.sort()
            c, x, p, to = (np.array(v) for v in zip(*entries)) if entries else (np.zeros(0, np.int64),) * 4
            starts = np.flatnonzero(np.diff(c, prepend=-1))
            self.seen.append((c.astype(np.int64), x.astype(np.int64), np.log(p.astype(float)), to.astype(np.int64), starts))
        self.ahead: list[np.ndarray] = [self.end]
        self.ended: dict[tuple[str, str], tuple[np.ndarray, np.ndarray]] = {}

    # ------------------------------------------------------------- letters to the end

    def _step(self, then: np.ndarray) -> np.ndarray:
        """For every state: the best score of one more letter and what ``then`` gives after it."""
        shorter, out = np.array([(self.log0 + then[self.after0]).max()]), []
        for order in (1, 2, 3):
            best = self.loss[order] + shorter[self.back[order]]
            c, _, logs, to, starts = self.seen[order]
            if len(c):
                best[c[starts]] = np.maximum(best[c[starts]], np.maximum.reduceat(logs + then[to], starts))
            out.append(best)
            shorter = best
        return np.concatenate([*out, [(self.log0 + then[self.after0]).max()]])

    def steps(self, n: int) -> list[np.ndarray]:
        """By the number of letters, 0 to ``n``: for every state the best score of so many more letters and the end of the word."""
        out = self.ahead[:n + 1]
        while len(out) <= n:
            out.append(self._step(out[-1]))
        self.ahead = max(self.ahead, out[:KEPT], key=len)
        return out

    def _best_letter(self, state: int, then: np.ndarray) -> tuple[int, int]:
        """(letter, state after it) of the best next letter of a state."""
        order = 0 if state == self.blank else 1 + (state >= self.base[2]) + (state >= self.base[3])
        node, lost, found = state - self.base[order], 0.0, []
        while order:
            c, x, logs, to, _ = self.seen[order]
            a, z = np.searchsorted(c, [node, node + 1])
            if z > a:
                value = logs[a:z] + then[to[a:z]]
                i = int(value.argmax())
                found.append((lost + float(value[i]), int(x[a + i]), int(to[a + i])))
            lost += float(self.loss[order][node])
            node, order = int(self.back[order][node]), order - 1
        value = self.log0 + then[self.after0]
        i = int(value.argmax())
        found.append((lost + float(value[i]), i, int(self.after0[i])))
        return max(found, key=lambda f: f[0])[1:]

    # ------------------------------------------------------- characters that are no letters

    def spent(self, run: str, kinds: str, may_drop, last: str, most: int) -> np.ndarray:
        """Least cost of a reading but for the letters' scores: by the number of its letters (0 to ``most`` - 1, then all larger
        numbers) and the last character read as a letter (``kinds``, then ``last`` if no letter was read).

        A letter early in a stretch of one character is never worse than a later one, so a long stretch is settled
        after ``most`` characters."""
        cost = np.full((most + 1, len(kinds) + 1), np.inf)
        cost[0, -1] = 0.0
        at = 0
        while at < len(run):
            ch, stop = run[at], at + 1
            while stop < len(run) and run[stop] == ch:
                stop += 1
            own = kinds.index(ch)
            skip = np.full(len(kinds) + 1, self.drop_cost if may_drop(ch) else np.inf)
            skip[own] = min(skip[own], self.repeat_cost)
            if last == ch:
                skip[-1] = min(skip[-1], self.repeat_cost)
            few = min(stop - at, most + 1)
            for _ in range(few):
                read = cost.min(axis=1) + self.mask_cost
                cost = cost + skip
                cost[1:, own] = np.minimum(cost[1:, own], read[:-1])
                cost[most, own] = min(cost[most, own], read[most])
            if stop - at > few:
                cost = cost + np.where(np.isinf(skip), np.inf, skip * (stop - at - few))
            at = stop
        return cost

    def _last(self, context: str, last: str, kinds: str) -> tuple[int, str]:
        """(state, the mask whose repeats are free of a letter)."""
        state = self.number.get(context, self.blank)
        return state, last if last and last in kinds and self.known[state] else ""

    def ending(self, states: dict, run: str, kinds: str) -> tuple[tuple | None, str]:
        """(link, letters) of the best reading of a run that ends a token; states: (context, last) -> (score, link)."""
        found = None
        for (context, last), (score, link) in states.items():
            state, mine = self._last(context, last, kinds)
            best, _ = self._ended(run, kinds, mine)
            total = score + float(best[state])
            if found is None or total > found[0]:
                found = total, link, state, mine
        _, link, state, mine = found
        n = int(self._ended(run, kinds, mine)[1][state])
        letters, steps = [], self.steps(n)
        for left in range(n, 0, -1):
            x, state = self._best_letter(state, steps[left - 1])
            letters.append(self.lm.letters[x])
        return link, "".join(letters)

    def _ended(self, run: str, kinds: str, last: str) -> tuple[np.ndarray, np.ndarray]:
        """For every state: the best score of the run to the end of the token, and its number of letters."""
        if (held := self.ended.get((run, last))) is not None:
            return held
        most = 16
        while True:
            cost = self.spent(run, kinds, lambda ch: True, last, most).min(axis=1)
            tried = np.stack([then - c for then, c in zip(self.steps(most - 1), cost)])
            best = tried.max(axis=0)
            if float(best.min()) >= -cost[most]:  # scores are logarithms: more letters cannot win
                break
            most *= 2
        if len(self.ended) >= KEPT:
            self.ended.clear()
        held = self.ended[(run, last)] = best, tried.argmax(axis=0)
        return held

    # --------------------------------------------------------------- letters inside a token

    def inside(self, states: dict, run: str, kinds: str, may_drop) -> dict:
        """(context, last) -> (score, link) after a run inside a token, from those before it."""
        out: dict = {}

        def put(key, score, link):
            if (old := out.get(key)) is None or score > old[0]:
                out[key] = score, link

        groups: dict[str, list] = {}
        for (context, last), (score, link) in states.items():
            state, mine = self._last(context, last, kinds)
            groups.setdefault(mine, []).append((state, context, last, score, link))
        for mine, members in groups.items():
            none = self.spent(run, kinds, may_drop, mine, 1)[0, -1]
            value, links = np.full(len(self.end), -np.inf), {}
            for state, context, last, score, link in members:
                if np.isfinite(none):
                    put((context, last), score - none, link)
                if score > value[state]:
                    value[state], links[state] = score, link
            top, most, trail, ways = float(value.max()), 8, [], []
            while True:
                cost = self.spent(run, kinds, may_drop, mine, most)
                while len(trail) < min(most - 1, len(run)):
                    value, source, letter = self._forward(value)
                    trail.append((source, letter))
                    ways.append(value)
                best = np.full((len(kinds), len(self.end)), -np.inf)
                count = np.zeros(best.shape, np.int64)
                for n in range(1, len(ways) + 1):
                    sums = ways[n - 1][None, :] - cost[n, :-1, None]
                    better = sums > best
                    best[better], count[better] = sums[better], n
                reached = best[np.isfinite(cost[1:, :-1]).any(axis=0)][:, self.free]
                if most > len(run) or reached.size and float(reached.min()) >= top - cost[most].min():
                    break
                most *= 2
            for k, state in zip(*(x.tolist() for x in np.nonzero(np.isfinite(best))), strict=True):
                put((self.names[state], kinds[k]), float(best[k, state]), Trail(trail, int(count[k, state]), state, links, self.lm.letters))
        return out

    def _forward(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """After one more letter: (best score of every state, the state it came from, the letter)."""
        new, source, letter = np.full(len(value), -np.inf), np.full(len(value), -1, np.int64), np.full(len(value), -1, np.int64)

        def scatter(to, sums, came, x):
            np.maximum.at(new, to, sums)
            hit = np.flatnonzero((sums == new[to]) & np.isfinite(sums))
            source[to[hit]], letter[to[hit]] = came[hit], x[hit]

        held, frm = None, None
        for order in (3, 2, 1):
            a, z = self.base[order], self.base[order] + self.sizes[order]
            own, own_from = value[a:z].copy(), np.arange(a, z)
            if held is not None:  # contexts that fall back to this one
                lost = held + self.loss[order + 1]
                np.maximum.at(own, self.back[order + 1], lost)
                hit = np.flatnonzero(np.isfinite(lost) & (lost == own[self.back[order + 1]]) & (lost > value[a:z][self.back[order + 1]]))
                own_from[self.back[order + 1][hit]] = frm[hit]
            c, x, logs, to, _ = self.seen[order]
            if len(c):
                scatter(to, own[c] + logs, own_from[c], x)
            held, frm = own, own_from
        lost, frm = np.append(held + self.loss[1], value[self.blank]), np.append(frm, self.blank)
        i = int(lost.argmax())
        scatter(self.after0, float(lost[i]) + self.log0, np.full(len(self.after0), frm[i]), np.arange(len(self.after0)))
        return new, source, letter


class Trail:
    """The letters that led to a state, spelt when they are asked for."""

    __slots__ = ("trail", "n", "state", "links", "letters")

    def __init__(self, trail, n, state, links, letters):
        self.trail, self.n, self.state, self.links, self.letters = trail, n, state, links, letters

    def spelt(self) -> tuple[str, tuple | None]:
        """(letters, what came before the run)."""
        out, s = [], self.state
        for source, letter in reversed(self.trail[:self.n]):
            out.append(self.letters[letter[s]])
            s = int(source[s])
        return "".join(reversed(out)), self.links[s]
