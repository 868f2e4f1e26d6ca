"""VIN check digit (ISO 3779, North-American position-9 scheme).

Built from native text and number expressions, so it stays inside generated
code with no Python UDF and no function per character.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------- FIXED VALUES
# Letter values (I, O and Q are not allowed in a VIN); digits keep their value.
TRANSLITERATION = {
    "A": 1, "B": 2, "C": 3, "D": 4, "E": 5, "F": 6, "G": 7, "H": 8,
    "J": 1, "K": 2, "L": 3, "M": 4, "N": 5, "P": 7, "R": 9,
    "S": 2, "T": 3, "U": 4, "V": 5, "W": 6, "X": 7, "Y": 8, "Z": 9,
}
# Position weights 1..17 (position 9 holds the check digit itself).
WEIGHTS = [8, 7, 6, 5, 4, 3, 2, 10, 0, 9, 8, 7, 6, 5, 4, 3, 2]
# ------------------------------------------------------------ END FIXED VALUES


def expected_check_digit(vin: Column) -> Column:
    """'0'-'9' or 'X' for a 17-character VIN; NULL for other lengths or bad letters."""
    digits = F.translate(vin, "".join(TRANSLITERATION), "".join(map(str, TRANSLITERATION.values())))
    n = F.when(digits.rlike("^[0-9]{17}$"), digits.cast("bigint"))  # 17 digits fit in 64 bits

    def check(n: Column) -> Column:
        digit = [F.call_function("div", n, F.lit(10 ** (16 - i)).cast("bigint")) % 10 for i in range(17)]
        r = sum((d * w for d, w in zip(digit, WEIGHTS) if w), F.lit(0)) % 11
        return F.when(r == 10, F.lit("X")).otherwise(r.cast("string"))

    return F.transform(F.array(n), check)[0]  # the number is read once, not for each of its digits


def check_digit_ok(vin: Column) -> Column:
    return F.substring(vin, 9, 1) == expected_check_digit(vin)
