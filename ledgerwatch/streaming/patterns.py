"""The patterns of a customer's new rows, from its timeline and recent rows."""

from collections import Counter, deque

import numpy as np

#: Measures of a second, in the order of a timeline's columns.
ALL, COUNTED, CENTS, TAKEOVER, SMALL, DECLINED, LARGE = range(7)
DAY = 86400


def additive(cfg, line, secs, first_large_from):
    """name -> per second, whether the windows of the additive patterns are full.

    Whether the row itself has the trait is for the caller to add.
    """
    takeover = line.trailing(secs, cfg.takeover_minutes * 60)[:, TAKEOVER]
    testing = line.trailing(secs, cfg.testing_minutes * 60)
    large = line.trailing(secs, cfg.identity_hours * 3600)[:, LARGE]
    day, month = line.trailing(secs, DAY), line.trailing(secs, cfg.bustout_days * DAY)
    earlier = month - day
    # As the batch compares them: exact sums of cents, then doubles.
    money, before = day[:, CENTS] / 100.0, earlier[:, CENTS] / 100.0
    with np.errstate(divide="ignore", invalid="ignore"):
        share = testing[:, DECLINED] / testing[:, SMALL]
    return {
        "account_takeover": takeover >= cfg.takeover_rows,
        "card_testing": (testing[:, SMALL] >= cfg.testing_rows) & (share >= cfg.testing_declined_share),
        "synthetic_identity": (large >= cfg.identity_rows)
        & (np.asarray(secs) <= first_large_from + cfg.identity_hours * 3600),
        "bust_out": (earlier[:, COUNTED] >= cfg.bustout_earlier_rows)
        & (day[:, COUNTED] >= cfg.bustout_recent_rows)
        & (money * earlier[:, COUNTED] >= cfg.bustout_factor * before * day[:, COUNTED]),
    }


def rising(cfg, rows):
    """(micros, id) of the rows that end a run of rising amounts at one merchant."""
    found, last, steps = set(), {}, Counter()
    for micros, name, merchant, cents, _ in rows:
        before = last.get(merchant)
        rises = (before is not None and cents is not None and before[1] is not None and cents > before[1]
                 and micros // 1_000_000 - before[0] // 1_000_000 <= cfg.probing_gap_minutes * 60)
        steps[merchant] = steps[merchant] + 1 if rises else 0
        last[merchant] = micros, cents
        if steps[merchant] >= cfg.probing_rows - 1:
            found.add((micros, name))
    return found


def collusion(cfg, rows, secs):
    """The seconds of ``secs`` whose trailing window has enough merchants close in amount.

    One sweep: the window's merchants are counted in and out, its extremes are kept in two queues.
    """
    span = cfg.collusion_minutes * 60
    risky = [(m // 1_000_000, merchant, cents) for m, _, merchant, cents, flag in rows if flag]
    found, at, first = set(), 0, 0
    merchants, high, low = Counter(), deque(), deque()
    for sec in sorted(secs):
        while at < len(risky) and risky[at][0] <= sec:
            _, merchant, cents = risky[at]
            merchants[merchant] += 1
            while high and risky[high[-1]][2] <= cents:
                high.pop()
            while low and risky[low[-1]][2] >= cents:
                low.pop()
            high.append(at)
            low.append(at)
            at += 1
        while first < at and risky[first][0] < sec - span:
            merchant = risky[first][1]
            merchants[merchant] -= 1
            if not merchants[merchant]:
                del merchants[merchant]
            for queue in (high, low):
                if queue and queue[0] == first:
                    queue.popleft()
            first += 1
        if len(merchants) >= cfg.collusion_merchants and (
                risky[high[0]][2] - risky[low[0]][2] <= round(cfg.collusion_spread * 100)):
            found.add(sec)
    return found
