"""What one key keeps of its past, in pieces of which a batch touches few.

``Timeline`` holds additive measures per second and answers their sums over any stretch of seconds.
The newest entries lie inline; when they become many, the older half moves into nodes: seconds in
their hour, hours in their day, days at the root.  A sum reads at most one day and one hour at each
end, and a batch writes the nodes its own rows moved into.

``Recent`` holds single rows of the last hours the same way: inline, then in blocks of ten minutes.

Both take a store with ``get``, ``put`` and ``remove``; every piece is read once a batch.
"""

import numpy as np

HOUR, DAY = 3600, 86400
BLOCK = 600


def merged(keys, values, more_keys, more_values):
    """Sorted distinct keys of both, with the sums of their value rows."""
    every, where = np.unique(np.concatenate([keys, more_keys]), return_inverse=True)
    out = np.zeros((len(every), values.shape[1]), np.int64)
    np.add.at(out, where, np.concatenate([values, more_values]))
    return every, out


class Timeline:
    """Sums of ``width`` whole-number measures; times are seconds.

    ``secs``/``sums`` are the inline entries, ``days``/``day_sums`` the root; flat lists from the state.
    """

    def __init__(self, width, store, secs=(), sums=(), days=(), day_sums=(), inline=256):
        self.width, self.store, self.inline = width, store, inline
        self.secs = np.array(secs, np.int64)
        self.sums = np.array(sums, np.int64).reshape(-1, width)
        self.days = np.array(days, np.int64)
        self.day_sums = np.array(day_sums, np.int64).reshape(-1, width)
        self.seen = {}

    def _node(self, level, at):
        if (level, at) not in self.seen:
            found = self.store.get((level, at))
            keys, sums = found if found else ([], [])
            self.seen[level, at] = (np.array(keys, np.int64), np.array(sums, np.int64).reshape(-1, self.width))
        return self.seen[level, at]

    def _into(self, level, at, keys, values):
        node = merged(*self._node(level, at), keys, values)
        self.seen[level, at] = node
        self.store.put((level, at), (node[0].tolist(), node[1].ravel().tolist()))

    def add(self, secs, values):
        """Add rows of measures at their seconds, which may repeat and come in any order."""
        self.secs, self.sums = merged(self.secs, self.sums, np.asarray(secs, np.int64),
                                      np.asarray(values, np.int64).reshape(-1, self.width))

    def _stored_upto(self, sec):
        total = self.day_sums[self.days < sec // DAY].sum(axis=0)
        if sec // DAY in self.days:
            hours, sums = self._node(DAY, sec // DAY)
            total = total + sums[hours < sec // HOUR].sum(axis=0)
            if sec // HOUR in hours:
                at, sums = self._node(HOUR, sec // HOUR)
                total = total + sums[at <= sec].sum(axis=0)
        return total

    def upto(self, secs):
        """The sums of everything up to each of ``secs``, itself included."""
        secs = np.asarray(secs, np.int64)
        running = np.vstack([np.zeros((1, self.width), np.int64), np.cumsum(self.sums, axis=0)])
        out = running[np.searchsorted(self.secs, secs, side="right")]
        if len(self.days):
            out = out + np.array([self._stored_upto(int(s)) for s in secs]).reshape(-1, self.width)
        return out

    def trailing(self, secs, span):
        """The sums over [sec - span, sec] for each of ``secs``."""
        secs = np.asarray(secs, np.int64)
        return self.upto(secs) - self.upto(secs - span - 1)

    def settle(self, oldest):
        """Forget what lies before ``oldest`` (whole days of nodes) and move what is too much inline."""
        fresh = self.secs >= oldest
        self.secs, self.sums = self.secs[fresh], self.sums[fresh]
        for day in self.days[(self.days + 1) * DAY <= oldest].tolist():
            for hour in self._node(DAY, day)[0].tolist():
                self.store.remove((HOUR, hour))
            self.store.remove((DAY, day))
        kept = (self.days + 1) * DAY > oldest
        self.days, self.day_sums = self.days[kept], self.day_sums[kept]
        if len(self.secs) <= self.inline:
            return
        moved = len(self.secs) - self.inline // 2
        secs, sums = self.secs[:moved], self.sums[:moved]
        self.secs, self.sums = self.secs[moved:], self.sums[moved:]
        for hour in np.unique(secs // HOUR).tolist():
            here = secs // HOUR == hour
            self._into(HOUR, hour, secs[here], sums[here])
            total = sums[here].sum(axis=0, keepdims=True)
            self._into(DAY, hour * HOUR // DAY, np.array([hour]), total)
            self.days, self.day_sums = merged(
                self.days, self.day_sums, np.array([hour * HOUR // DAY]), total)


class Recent:
    """Rows (micros, id, merchant, cents, risky) of the last hours; ``blocks`` are those in the store."""

    def __init__(self, store, rows=(), blocks=(), inline=256):
        self.store, self.rows, self.blocks, self.inline = store, sorted(rows, key=order), set(blocks), inline
        self.seen = {}

    def _block(self, at):
        if at not in self.seen:
            found = self.store.get((at,))
            self.seen[at] = list(zip(*found)) if found else []
        return self.seen[at]

    def add(self, rows):
        self.rows = sorted([*self.rows, *rows], key=order)

    def between(self, low, high):
        """All rows of the seconds from ``low`` to ``high``, in order."""
        out = [r for r in self.rows if low <= r[0] // 1_000_000 <= high]
        for at in self.blocks:
            if (at + 1) * BLOCK > low and at * BLOCK <= high:
                out += [r for r in self._block(at) if low <= r[0] // 1_000_000 <= high]
        return sorted(out, key=order)

    def settle(self, oldest):
        self.rows = [r for r in self.rows if r[0] // 1_000_000 >= oldest]
        for at in [b for b in self.blocks if (b + 1) * BLOCK <= oldest]:
            self.store.remove((at,))
            self.blocks.discard(at)
        if len(self.rows) <= self.inline:
            return
        moved = self.rows[:-(self.inline // 2)]
        self.rows = self.rows[-(self.inline // 2):]
        for at in sorted({r[0] // 1_000_000 // BLOCK for r in moved}):
            here = [r for r in moved if r[0] // 1_000_000 // BLOCK == at]
            held = sorted([*(self._block(at) if at in self.blocks else []), *here], key=order)
            self.seen[at] = held
            self.blocks.add(at)
            self.store.put((at,), tuple(map(list, zip(*held))))


def order(row):
    return row[0], row[1]
