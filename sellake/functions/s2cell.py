"""S2 cell ids (level 30 leaf, parents, tokens) as column expressions.

Cube face -> (u, v) -> quadratic (s, t) -> (i, j) on a 2^30 grid -> Hilbert
position per face, following the published S2 geometry scheme. The position
lookup table (1024 entries) is generated from the recursive Hilbert rule below.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values of the S2 scheme ----------------------------------------------
MAX_LEVEL = 30
LOOKUP_BITS = 4
SWAP_MASK = 1
INVERT_MASK = 2
POS_TO_IJ = ((0, 1, 3, 2), (0, 2, 3, 1), (3, 2, 0, 1), (3, 1, 0, 2))
POS_TO_ORIENTATION = (SWAP_MASK, 0, 0, INVERT_MASK | SWAP_MASK)
# ---------------------------------------------------------------------------------


def _build_lookup() -> np.ndarray:
    pos_table = np.zeros(1 << (2 * LOOKUP_BITS + 2), dtype=np.int64)

    def init(level, i, j, orig, pos, orient):
        if level == LOOKUP_BITS:
            ij = (i << LOOKUP_BITS) + j
            pos_table[(ij << 2) + orig] = (pos << 2) + orient
            return
        r = POS_TO_IJ[orient]
        for k in range(4):
            init(level + 1, (i << 1) + (r[k] >> 1), (j << 1) + (r[k] & 1), orig, (pos << 2) + k,
                 orient ^ POS_TO_ORIENTATION[k])

    for o in (0, SWAP_MASK, INVERT_MASK, SWAP_MASK | INVERT_MASK):
        init(0, 0, 0, o, 0, o)
    return pos_table


LOOKUP_POS = _build_lookup()


def cell_token(lat: Column, lng: Column, level: int) -> Column:
    """Token of the cell of ``level`` (0 to 30) that holds a point in degrees; NULL for NULL. Column expressions only."""
    lat, lng = F.radians(lat), F.radians(lng)
    x, y, z = F.cos(lat) * F.cos(lng), F.cos(lat) * F.sin(lng), F.sin(lat)
    ax, ay, az = F.abs(x), F.abs(y), F.abs(z)
    axis = F.when((ax >= ay) & (ax >= az), 0).when(ay >= az, 1).otherwise(2)
    part = F.when(axis == 0, x).when(axis == 1, y).otherwise(z)
    face = axis + F.when(part < 0, 3).otherwise(0)
    # the two other coordinates of the face's plane, divided by its own
    over = lambda a, b: F.try_divide(a, b)
    u = F.when(face == 0, over(y, x)).when(face == 1, over(-x, y)).when(face == 2, over(-x, z)).when(face == 3, over(z, x)).when(face == 4, over(z, y)).otherwise(over(-y, z))
    v = F.when(face == 0, over(z, x)).when(face == 1, over(z, y)).when(face == 2, over(-y, z)).when(face == 3, over(y, x)).when(face == 4, over(-x, y)).otherwise(over(-x, z))
    st = lambda c: F.when(c >= 0, F.lit(0.5) * F.sqrt(1 + 3 * c)).otherwise(1 - F.lit(0.5) * F.sqrt(1 - 3 * c))
    size = 1 << MAX_LEVEL
    grid = lambda c: F.greatest(F.lit(0).cast("long"), F.least(F.lit(size - 1).cast("long"), F.floor(size * st(c))))
    # eight look-ups of four bits of i and of j each; the low two bits of a look-up turn the curve for the next
    table, point = F.lit(LOOKUP_POS.tolist()), F.struct(face.cast("long").alias("face"), grid(u).alias("i"), grid(v).alias("j"))
    four = lambda c, k: F.call_function("shiftright", c, k * LOOKUP_BITS).bitwiseAND(F.lit(15).cast("long"))

    def step(acc, k):
        at = acc["bits"] + four(acc["i"], k) * 64 + four(acc["j"], k) * 4
        got = F.get(table, at.cast("int"))
        return F.struct((acc["n"] * 256 + F.shiftright(got, 2)).alias("n"), got.bitwiseAND(F.lit(3).cast("long")).alias("bits"), acc["i"].alias("i"), acc["j"].alias("j"))

    start = F.struct(F.lit(0).cast("long").alias("n"), point["face"].bitwiseAND(F.lit(1).cast("long")).alias("bits"), point["i"].alias("i"), point["j"].alias("j"))
    place = F.aggregate(F.array(*[F.lit(k) for k in range(7, -1, -1)]), start, step, lambda acc: acc["n"])  # 60 bits
    leaf = F.shiftleft(F.shiftleft(point["face"], 60).bitwiseOR(place), 1).bitwiseOR(F.lit(1).cast("long"))
    low = 1 << 2 * (MAX_LEVEL - level)
    cell = leaf.bitwiseAND(F.lit(-low).cast("long")).bitwiseOR(F.lit(low).cast("long"))
    return F.when(lat.isNotNull() & lng.isNotNull(), F.rtrim(F.lower(F.lpad(F.hex(cell), 16, "0")), F.lit("0")))
