"""Message texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space at the ends of a name.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# Fixed value: name used when both parts are blank.
NO_NAME = "Collaborateur"


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.trim(text, F.lit(WHITE_SPACE))


def full_name(first: Column, last: Column) -> Column:
    """``first last`` without outer blanks; a stand-in when nothing is left."""
    blank = F.lit("")
    name = strip(F.concat(F.coalesce(first, blank), F.lit(" "), F.coalesce(last, blank)))
    return F.when(name == "", F.lit(NO_NAME)).otherwise(name)


def congratulation(first: Column, last: Column, comment: Column) -> Column:
    """Praise for one activity; an empty or missing comment gives the short form."""
    bravo = F.concat(F.lit("Bravo "), full_name(first, last), F.lit(" !"))
    with_comment = F.concat(bravo, F.lit(" c'est "), comment, F.lit(" !"))
    return F.when(F.length(comment) > 0, with_comment).otherwise(bravo)
