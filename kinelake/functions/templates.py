"""Templates of prompts: ``<field:rule>``, with ``!`` for pieces that bear no loss and ``@n`` for the most characters."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from kinelake.functions.chain import modalities

_FIELD = re.compile(r"<(?P<field>[a-z_]+):(?P<rule>[a-z]+)(?P<quiet>!)?(?:@(?P<limit>\d+))?>")


@dataclass(frozen=True)
class Piece:
    """Static text, or a field by a rule; ``loss`` tells whether its tokens are learned."""

    text: str = ""
    field: str | None = None
    rule: str | None = None
    loss: bool = False
    limit: int | None = None

    def column(self) -> Column:
        if self.field is None:
            return F.lit(self.text)
        spec = {"name": self.rule} | ({"limit": self.limit} if self.limit is not None else {})
        return F.coalesce(modalities.build(spec)(F.col(self.field)), F.lit(""))


def parse(template: str) -> list[Piece]:
    out, at = [], 0
    for m in _FIELD.finditer(template):
        if m.start() > at:
            out.append(Piece(text=template[at : m.start()]))
        limit = m["limit"]
        out.append(Piece(field=m["field"], rule=m["rule"], loss=not m["quiet"], limit=int(limit) if limit else None))
        at = m.end()
    if at < len(template):
        out.append(Piece(text=template[at:]))
    return out


def rendered(pieces: list[Piece]) -> Column:
    return F.concat(*[p.column() for p in pieces])


def tokens(c: Column) -> Column:
    """Words between blanks, without empty ones."""
    return F.filter(F.split(c, " +"), lambda x: x != "")


def assembled(pieces: list[Piece], width: int, pad: str = "<pad>", ignore: str = "<ignore>") -> tuple[Column, Column, Column]:
    """Tokens, labels and mask, each of ``width`` places: cut or padded on the right; pieces without loss are ignored in the labels."""
    each = [(tokens(p.column()), p.loss) for p in pieces]
    ids = F.concat(*[t for t, _ in each])
    labels = F.concat(*[t if loss else F.transform(t, lambda _: F.lit(ignore)) for t, loss in each])

    def fixed(a: Column, fill: str) -> Column:
        return F.concat(F.slice(a, 1, width), F.array_repeat(F.lit(fill), F.greatest(F.lit(width) - F.size(a), F.lit(0))))

    return fixed(ids, pad), fixed(labels, ignore), F.transform(F.sequence(F.lit(1), F.lit(width)), lambda i: i <= F.size(ids))
