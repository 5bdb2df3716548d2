"""Data and helpers of the operator tests."""

import re

SF001, SF01 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Texts that every operator must take.
ODD_TEXTS = [None, "", "   \n\t ", "one", "a b c d", "été \U0001f600 naïve", "x" * 5000, "tab\tsep\x0bvt\x0cff\rcr\nlf",
             "no break  em", "| pipe | pipe", "ends with space "]


def words(text):
    return WORD.findall(text or "")
