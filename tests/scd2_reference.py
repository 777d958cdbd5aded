"""Sequential reference of the merge rules, for tests: one change at a time,
in time order, exactly as the rules in ``starling.operators.scd2`` read."""

from __future__ import annotations

from dataclasses import dataclass, field

OPEN_END = "9999-12-31 00:00:00"
RANK = {"D": 2, "U": 1}


@dataclass
class FoldState:
    active: dict = field(default_factory=dict)      # key -> version dict
    tombstones: dict = field(default_factory=dict)  # key -> delete time
    closed: list = field(default_factory=list)
    late: list = field(default_factory=list)


def fold_batch(state: FoldState, batch: list[dict], key: str, hash_col: str, order_rest: list[str],
               type1: tuple[str, ...] = ()) -> FoldState:
    """Apply one batch. Changes are dicts with ``op``, ``ts`` (sortable text),
    the key, the hash and the payload columns."""
    ok = []
    for c in batch:
        k = c[key]
        b = state.active[k]["start"] if k in state.active else state.tombstones.get(k)
        if c["ts"] is None or (b is not None and c["ts"] <= b):
            state.late.append({**c, "boundary": b})
        else:
            ok.append(c)
    # rule 6: one change per (key, ts)
    best: dict = {}
    for c in ok:
        g = (c[key], c["ts"])
        order = (RANK.get(c["op"], 0), c[hash_col], *[c[t] for t in type1], *[c[r] for r in order_rest])
        if g not in best or order > best[g][0]:
            best[g] = (order, c)
    for (_k, _ts), (_o, c) in sorted(best.items(), key=lambda kv: (kv[0][0], kv[0][1])):
        k, t = c[key], c["ts"]
        cur = state.active.get(k)
        if c["op"] == "D":
            if cur is not None:
                state.closed.append({**cur, "end": t, "flag": 0})
                del state.active[k]
                state.tombstones[k] = t
        elif cur is not None and cur[hash_col] == c[hash_col]:
            for col in type1:
                cur[col] = c[col]
        else:
            if cur is not None:
                state.closed.append({**cur, "end": t, "flag": 0})
            state.active[k] = {**c, "start": t, "end": OPEN_END, "flag": 1}
            state.tombstones.pop(k, None)
    return state


def versions(state: FoldState, cols: list[str]) -> list[tuple]:
    rows = list(state.closed) + list(state.active.values())
    return sorted(tuple(r[c] for c in cols) + (r["start"], r["end"], r["flag"]) for r in rows)
