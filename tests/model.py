"""Row-at-a-time model of the merge, to check the Spark jobs against."""

from __future__ import annotations

FLOOR = 0


def rank(flag):
    return "ZZ" if flag == "D" else flag


def order(row):
    key, stamp, flag, value = row
    flag = rank(flag)
    return (stamp is not None, stamp or 0, flag is not None, flag or "", value)


def latest(rows):
    best = {}
    for row in rows:
        if row[0] is not None and (row[0] not in best or order(row) > order(best[row[0]])):
            best[row[0]] = row
    return best


def current_state(rows):
    return {k: (s, v) for k, (_, s, f, v) in latest(rows).items() if f != "D"}


def merge(target, changes, compare=False):
    out = dict(target)
    for key, stamp, flag, value in changes.values():
        old = target.get(key)
        if compare and old is not None and old[0] is not None and (stamp is None or stamp < old[0]):
            continue
        if old is None:
            if flag != "D":
                out[key] = (stamp, value)
        elif flag == "D":
            del out[key]
        elif flag in ("I", "U", "L"):
            out[key] = (stamp, value)
    return out


def apply(target, arrived):
    mark = max((s for s, _ in target.values() if s is not None), default=FLOOR)
    return merge(target, latest([r for r in arrived if r[1] is not None and r[1] >= mark]))
