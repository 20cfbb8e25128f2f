"""Reversible chains of vector transforms, and names that stand for column functions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

Transform = Callable[[Column], Column]


@dataclass(frozen=True)
class Step:
    """A transform of a vector and, if there is one, its inverse."""

    name: str
    forward: Transform
    backward: Transform | None = None


@dataclass
class Chain:
    """Steps applied in order; the inverse applies the inverses in reverse order. ``width`` is what vectors have at both ends."""

    steps: list[Step] = field(default_factory=list)

    @property
    def invertible(self) -> bool:
        return all(s.backward is not None for s in self.steps)

    def forward(self, c: Column) -> Column:
        return reduce(lambda x, s: s.forward(x), self.steps, c)

    def backward(self, c: Column) -> Column:
        if not self.invertible:
            raise ValueError(f"no inverse of {[s.name for s in self.steps if s.backward is None]}")
        return reduce(lambda x, s: s.backward(x), reversed(self.steps), c)

    def checked(self, c: Column, width: Column) -> Column:
        """Null where the vector does not have the width before or after."""
        y = self.forward(c)
        return F.when((F.size(c) == width) & (F.size(y) == width), y)


class Named:
    """Functions by name: builders of prompts, rules for a modality, masks, codecs. A configuration names them; users add their own."""

    def __init__(self, kind: str):
        self.kind, self.known = kind, {}

    def register(self, name: str) -> Callable:
        def add(fn: Callable) -> Callable:
            if name in self.known:
                raise ValueError(f"{self.kind} {name} exists")
            self.known[name] = fn
            return fn

        return add

    def build(self, spec: dict) -> Callable:
        """The function that ``spec["name"]`` stands for, with the other entries bound as keywords."""
        name = spec.get("name")
        if name not in self.known:
            raise KeyError(f"no {self.kind} {name}; known: {sorted(self.known)}")
        more = {k: v for k, v in spec.items() if k != "name"}
        return lambda *a: self.known[name](*a, **more)


def each(fn: Callable[[Column], Column]) -> Transform:
    return lambda c: F.transform(c, fn)


transforms, modalities = Named("transform"), Named("modality")


@transforms.register("relative")
def relative(base: Column) -> Step:
    return Step("relative", lambda c: F.zip_with(c, base, lambda a, b: a - b), lambda c: F.zip_with(c, base, lambda a, b: a + b))


@transforms.register("arcsinh")
def arcsinh(gain: float = 1.0) -> Step:
    """Stable for values of either sign: the logarithm is taken of the size."""

    def squeeze(x: Column) -> Column:
        y = F.abs(x) * gain
        return F.signum(x) * F.log(y + F.sqrt(y * y + 1))

    return Step("arcsinh", each(squeeze), each(lambda y: F.sinh(y) / gain))


@transforms.register("scale")
def scale(factor: float) -> Step:
    return Step("scale", each(lambda x: x * factor), each(lambda x: x / factor))


@modalities.register("text")
def text_rule(c: Column, limit: int | None = None) -> Column:
    s = F.lower(F.trim(c.cast("string")))
    return s if limit is None else F.substring(s, 1, limit)


@modalities.register("number")
def number_rule(c: Column, step: float = 1.0) -> Column:
    """A number by the number of its bin."""
    return F.concat(F.lit("<n"), F.floor(c / step).cast("string"), F.lit(">"))


@modalities.register("set")
def set_rule(c: Column, limit: int | None = None) -> Column:
    """The distinct entries of a list in order, joined by bars."""
    return F.array_join(F.array_sort(F.array_distinct(F.filter(c, lambda x: x.isNotNull()))), "|")
