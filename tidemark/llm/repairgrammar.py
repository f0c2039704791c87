"""The cheapest repair of a conversation's turns, by weighted interval parsing.

A repaired conversation reads ``(s?(ua)+)?`` in the initials of its roles: nothing, or an optional
system turn and pairs of user and assistant turns. The grammar is in Chomsky normal form over pairs of
places in that pattern: the nonterminal (p, q) covers rows that, once edited, lead from place p to q,

    (p, q) -> (p, r) (r, q)        two neighbouring spans
    (p, q) -> row                  one row, kept, given another role, or deleted

Each span has a cell for each nonterminal, the least (cost, audit) of its derivations, where the audit
is the edits' initials in order. Cells are closed under insertion: an inserted turn may stand before
and after every row. Spans are combined bottom-up by length. As the pattern is regular, a span's cells
are the same however it is divided, so every length needs neighbouring spans only, and spans made in
different tasks can be combined later. The least pair of a span is a sum and a concatenation of least
pairs of its parts: of two derivations of one span by the same nonterminal, at the same cost, neither
audit begins with the other, as the longer one would have paid for more insertions.
"""

from __future__ import annotations

from collections.abc import Iterable

# What the edits cost.
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3

#: Places: at the start, after the system turn, after a user turn, after an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Where a turn with this initial can stand: from a place to the next.
TURNS = {"s": [(START, SYSTEM)], "u": [(START, USER), (SYSTEM, USER), (ASSISTANT, USER)], "a": [(USER, ASSISTANT)]}
ACCEPTED = [(START, START), (START, ASSISTANT)]

Cell = dict[tuple[int, int], tuple[int, str]]


def _least(cell: Cell, pair: tuple[int, int], value: tuple[int, str]) -> None:
    if pair not in cell or value < cell[pair]:
        cell[pair] = value


def combine(left: Cell, right: Cell) -> Cell:
    """Cells of a span from those of its two parts."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in range(4):
            other = right.get((r, q))
            if other is not None:
                _least(out, (p, q), (cost + other[0], audit + other[1]))
    return out


def _insertions() -> Cell:
    """Cells of no rows: what inserted turns alone lead to."""
    cell: Cell = {(p, p): (0, "") for p in range(4)}
    for pair in TURNS["u"] + TURNS["a"]:
        cell[pair] = (INSERT_COST, "I")
    while (wider := combine(cell, cell)) != cell:
        cell = wider
    return cell


EMPTY = _insertions()


def _row(symbol: str) -> Cell:
    """Cells of one row: its initial (x: another one) and its fault (b, d, t, or a dot for none)."""
    initial, fault = symbol
    cell: Cell = {(p, p): (DELETE_COST, "D") for p in range(4)}
    if fault not in "bd":
        more = TRUNCATED_COST if fault == "t" else 0
        for pair in TURNS["u"] + TURNS["a"]:
            _least(cell, pair, (REROLE_COST + more, "R"))
        for pair in TURNS.get(initial, []):
            _least(cell, pair, (more, "K"))
    return combine(combine(EMPTY, cell), EMPTY)


ROWS = {i + f: _row(i + f) for i in "suax" for f in "bdt."}
#: Cells of short spans, which recur in many conversations.
_known: dict[str, Cell] = dict(ROWS)
_KNOWN_ROWS, _KNOWN_SPANS = 8, 1 << 15


def span_cells(symbols: str) -> Cell:
    """Cells of a span of rows, two characters each, combined bottom-up by length."""
    spans = [(symbols[i : i + 2], ROWS[symbols[i : i + 2]]) for i in range(0, len(symbols), 2)]
    while len(spans) > 1:
        wider = []
        for (a, left), (b, right) in zip(spans[::2], spans[1::2], strict=False):
            cell = _known.get(a + b)
            if cell is None:
                cell = combine(left, right)
                if len(a + b) <= 2 * _KNOWN_ROWS and len(_known) < _KNOWN_SPANS:
                    _known[a + b] = cell
            wider.append((a + b, cell))
        spans = wider + spans[len(wider) * 2 :]
    return spans[0][1] if spans else EMPTY


def join_spans(cells: Iterable[Cell]) -> Cell:
    """Cells of neighbouring spans in order, combined in rounds."""
    spans = list(cells)
    while len(spans) > 1:
        wider = [combine(a, b) for a, b in zip(spans[::2], spans[1::2], strict=False)]
        spans = wider + spans[len(wider) * 2 :]
    return spans[0] if spans else EMPTY


def best(cell: Cell) -> tuple[int, str]:
    return min(cell[pair] for pair in ACCEPTED if pair in cell)


def edits(symbols: str, audit: str) -> Iterable[tuple[str, str, str, str]]:
    """Per row: roles inserted before it, its edit, its new role (rerole only), roles inserted after the last."""
    place, pending, at, out = START, "", 0, []
    for letter in audit:
        turn = symbols[at] if letter == "K" else "u" if place != USER else "a"
        if letter != "D":
            place = dict(TURNS[turn])[place]
        if letter == "I":
            pending += turn
        else:
            out.append((pending, letter, turn if letter == "R" else "", ""))
            pending, at = "", at + 2
    if out and pending:
        out[-1] = (*out[-1][:3], pending)
    return out
