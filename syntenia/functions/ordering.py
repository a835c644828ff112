"""Sort keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: ASCII characters that are neither letters nor digits; a version sort puts them behind the letters.
MARKS = "".join(chr(i) for i in range(32, 126) if not chr(i).isalnum())
#: Digits to which a run of digits is filled up.
WIDTH = 40


def natural_key(text: Column) -> Column:
    """A string that sorts as names do in a version sort: runs of digits by their number, letters before marks, ``~`` before even the end.

    A ``~`` behind a run of zeros sorts behind the number 0, where a version sort skips it.
    Numbers of more than ``WIDTH`` digits sort by their last ``WIDTH``. Endings such as
    ``.txt``, which a version sort of file names sets aside, count like the rest.
    """
    moved = F.translate(text, MARKS + "~", "".join(chr(0xE000 + ord(c)) for c in MARKS) + "\x01")
    parts = F.regexp_extract_all(moved, F.lit(r"([0-9]+|[^0-9]+)"), F.lit(1))
    padded = F.array_join(F.transform(parts, lambda p: F.when(p.rlike("^[0-9]"), F.lpad(F.right(p, F.lit(WIDTH)), WIDTH, "0")).otherwise(p)), "")
    return F.concat(padded, F.lit("\x02"))  # the end of a name comes before all but ~
