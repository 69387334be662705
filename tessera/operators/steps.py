"""Per-key sequential rules: one row in, next state and outcome out.

Each factory returns a ``step(state, *values)`` for :func:`fold_rows` in batch
and for the stateful stream of :mod:`tessera.streaming.stateful`. Times are
whole microseconds; a state is anything JSON can hold, ``None`` at first.

A step whose states have few shapes may name them, so that blocks of a hot key become maps that compose:
``entries`` lists ``(name, state)`` of the states a block can be entered with, with marks in place of values;
``entry_of(state)`` is the name of a state (``None`` if no entry stands for it); ``fill(exit, state)`` puts the
values of the entered state in place of the marks.
"""

from __future__ import annotations

from collections.abc import Callable

SECOND = 1_000_000


def machine(transitions: dict[tuple[str, str], str], initial: str) -> Callable:
    """State machine: a known event moves on, an unknown one reports failure and stays (G-4)."""
    table = {f"{a}\u0000{b}": c for (a, b), c in transitions.items()}

    def step(state, event):
        now = initial if state is None else state
        then = table.get(f"{now}\u0000{event}")
        return (now, (False, now)) if then is None else (then, (True, then))

    step.entries = [(s, s) for s in sorted({initial, *transitions.values(), *[a for a, _ in transitions]})]
    step.entry_of = lambda state: initial if state is None else state
    step.fill = lambda found, state: found
    return step


#: Longest history whose blocks are composed; the number of shapes grows as its square.
COMPOSED_HISTORY = 20


def undo_redo(max_history: int = 10) -> Callable:
    """Editor history: execute, undo and redo over two stacks (G-5)."""

    def step(state, op, value):
        history, redo, current = ([], [], None) if state is None else state
        if op == "execute":
            if current is not None:
                history = (history + [current])[-max_history:]
            redo, current = [], value
        elif op == "undo" and history:
            redo, current, history = redo + [current], history[-1], history[:-1]
        elif op == "redo" and redo:
            history, current, redo = (history + [current])[-max_history:], redo[-1], redo[:-1]
        return [history, redo, current], (current,)

    def entry_of(state):
        """Lengths of both stacks; a stack that holds NULL has no entry, since NULL is not pushed like a value."""
        history, redo, current = ([], [], None) if state is None else state
        if current is None:
            return "none" if not history and not redo else None
        return None if None in history or None in redo else f"{len(history)},{len(redo)}"

    def fill(found, state):
        places = dict(zip("hrc", ([], [], [None]) if state is None else (state[0], state[1], [state[2]])))

        def value(x):
            return places[x[0]][x[1]] if isinstance(x, list) else x

        return [[value(x) for x in found[0]], [value(x) for x in found[1]], value(found[2])]

    def shape(h, r):
        return [[["h", i] for i in range(h)], [["r", i] for i in range(r)], ["c", 0]]

    if max_history <= COMPOSED_HISTORY:  # both stacks together hold max_history values at most
        step.entries = [("none", None)] + [(f"{h},{r}", shape(h, r)) for h in range(max_history + 1)
                                           for r in range(max_history + 1 - h)]
        step.entry_of, step.fill = entry_of, fill
    return step


def _past_nulls(step: Callable, outcomes: int = 1, ends: Callable | None = None) -> Callable:
    """Rows without a time pass the rule with NULL outcomes and leave its state as it is.

    ``ends(state)`` is the time after which a state decides like none, so that a stream may forget it.
    """

    def run(state, t, *rest):
        if t is None or t != t:
            return state, (None,) * outcomes
        return step(state, int(t), *rest)

    run.ends = ends
    return run


def sliding_limiter(max_calls: int, window: int) -> Callable:
    """At most ``max_calls`` allowed calls per window; refused calls do not count (ST-3).

    A call exactly ``window`` old still counts.
    """

    def step(state, t):
        calls = [c for c in (state or []) if t - c <= window]
        if len(calls) >= max_calls:
            return calls, (False,)
        return calls + [t], (True,)

    return _past_nulls(step, ends=lambda calls: max(calls, default=0) + window)


def _asked(tokens, need: int) -> int:
    """Tokens a call asks for; ``need`` where the row does not say."""
    return need if tokens is None or tokens != tokens else int(tokens)


def bucket_discrete(capacity: int, rate: float, need: int = 1) -> Callable:
    """Bucket that starts empty and refills whole tokens; fractions are lost (ST-4).

    A second value is the number of tokens of this call, ``need`` if it is NULL or not given.
    """

    def step(state, t, asked=None):
        want = _asked(asked, need)
        tokens, last = (0, t) if state is None else state
        tokens = min(capacity, tokens + int((t - last) / SECOND * rate))
        taken = tokens >= want
        return [tokens - want if taken else tokens, t], (taken,)

    return _past_nulls(step)


def bucket_continuous(capacity: int, rate: float, need: int = 1) -> Callable:
    """Bucket that starts full and makes the caller wait instead of refusing (ST-5).

    A call is served after its wait, so a following one cannot start earlier. A second value is the number
    of tokens of this call, ``need`` if it is NULL or not given.
    """

    def step(state, t, asked=None):
        want = _asked(asked, need)
        tokens, last = (float(capacity), t) if state is None else state
        now = max(t, last)
        tokens = min(float(capacity), tokens + (now - last) / SECOND * rate)
        if tokens < want:
            now += round((want - tokens) / rate * SECOND)
            tokens = float(want)
        return [tokens - want, now], ((now - t) / SECOND,)

    full = round((capacity / rate + 1) * SECOND)  # a full bucket is what a new one is
    return _past_nulls(step, ends=lambda state: state[1] + full)


def replay_guard(ttl: int = 86_400 * SECOND) -> Callable:
    """First response, body and status code, kept for ``ttl``; repeats get it flagged, later ones a new one (ST-6)."""

    def step(state, t, body, status=None):
        if state is not None and t - state[0] < ttl:
            return state, (state[1], True, state[2])
        status = None if status is None or status != status else int(status)
        return [t, body, status], (body, False, status)

    return _past_nulls(step, 3, ends=lambda state: state[0] + ttl)


def ttl_cache(ttl: int) -> Callable:
    """Hit while the kept result is younger than ``ttl``, else recomputed (E-13)."""

    def step(state, t):
        if state is not None and t - state < ttl:
            return state, (True,)
        return t, (False,)

    return _past_nulls(step, ends=lambda t: t + ttl)


def rolling(n: int) -> Callable:
    """Counts among the last ``n`` items (ST-2), as ``item:count`` in item order; NULL takes a place, but is not counted."""

    def step(state, item):
        last = [*(state or []), None if item != item else item][-n:]
        return last, (",".join(f"{i}:{last.count(i)}" for i in sorted(set(last) - {None})),)

    return step
