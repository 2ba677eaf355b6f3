"""Walks over the elements of an array inside a row, in time that grows with their number."""

from pyspark.sql import functions as F

#: Elements walked over before what they gave is set aside.
_CHUNK = 256


def walk(elements, state, given, step):
    """What `step` gives over the array: the final state, and `out`, all it gave in order.

    `state` names the parts of the state and their first values, `given` is the type of what
    is given. `step(s, e)` takes the state and an element, and returns the new parts by name
    and an array of what it gives. Appending to an array copies it, so what is given is
    gathered by chunks first.
    """
    names = list(state)
    nothing = F.array().cast(f"array<{given}>")
    nothing_yet = F.array().cast(f"array<array<{given}>>")

    def struct(values, out):
        return F.struct(*[values[n].alias(n) for n in names], out.alias("out"))

    def one(s, e):
        values, out = step(s, e)
        return struct(values, F.concat(s["out"], out))

    def chunk(s, elements):
        inner = F.aggregate(elements, struct({n: s[n] for n in names}, nothing), one)
        # As the one element of an array, the chunk is walked over once.
        return F.get(F.transform(F.array(inner), lambda i: struct(i, F.concat(s["out"], F.array(i["out"])))), 0)

    numbers = F.sequence(F.lit(0), F.floor((F.size(elements) - 1) / _CHUNK).cast("int"))
    chunks = F.when(F.size(elements) > 0, F.transform(numbers, lambda c: F.slice(elements, c * _CHUNK + 1, F.lit(_CHUNK))))
    whole = F.aggregate(F.coalesce(chunks, F.array(elements)), struct(state, nothing_yet), chunk)
    flat = F.transform(F.array(whole), lambda s: F.struct(*[s[n].alias(n) for n in names], F.flatten(s["out"]).alias("out")))
    return F.get(flat, 0)
