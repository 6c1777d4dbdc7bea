"""Weighted finite-state transducers over small alphabets, and their composition.

A transducer reads symbols one by one; in its state it turns a symbol into another,
goes to a next state and pays the arc's weight. Symbols without an arc pass unchanged,
stay in the state and weigh nothing. Weights are tuples of labels, joined along a
path: a formal product, which the caller evaluates with numbers of its own.

``compose`` makes one transducer that does what two do one after the other. Its states
are the pairs that can be reached, so a chain of transducers is run in one pass.

Defined results: an empty sequence gives an empty one and no weight.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

Arc = tuple[int, str, tuple[str, ...]]


@dataclass(frozen=True)
class Transducer:
    """``arcs``: (state, symbol) -> (next state, output, weight); it starts in state 0."""
    arcs: dict[tuple[int, str], Arc]

    def arc(self, state: int, symbol: str) -> Arc:
        return self.arcs.get((state, symbol), (state, symbol, ()))

    def read(self, symbols: Iterable[str]) -> list[tuple[str, tuple[str, ...]]]:
        """(output, weight) of every symbol."""
        out, state, arcs = [], 0, self.arcs
        for s in symbols:
            found = arcs.get((state, s))
            if found is None:
                out.append((s, ()))
            else:
                state = found[0]
                out.append(found[1:])
        return out


def compose(first: Transducer, second: Transducer, alphabet: str) -> Transducer:
    """``first``, then ``second`` on what it puts out; ``alphabet`` is what the first reads."""
    numbers, todo, arcs = {(0, 0): 0}, [(0, 0)], {}
    while todo:
        pair = todo.pop()
        for symbol in alphabet:
            a, middle, paid = first.arc(pair[0], symbol)
            b, out, more = second.arc(pair[1], middle)
            if (a, b) not in numbers:
                numbers[a, b] = len(numbers)
                todo.append((a, b))
            arcs[numbers[pair], symbol] = (numbers[a, b], out, paid + more)
    return Transducer(arcs)


def chain(steps: list[Transducer], alphabet: str) -> Transducer:
    whole = steps[0]
    for step in steps[1:]:
        whole = compose(whole, step, alphabet)
    return whole
