"""Metaphone after Lawrence Philips's published rules, word by word."""

from __future__ import annotations

import re

_SILENT_START = re.compile(r"^(?:AE|GN|KN|PN|WR)")


def metaphone(text: str) -> str:
    """Codes of the words of a text, joined by spaces; letters outside A-Z are ignored."""
    return " ".join(filter(None, (_word(re.sub("[^A-Z]", "", w)) for w in text.upper().split())))


def _word(w: str) -> str:
    if _SILENT_START.match(w):
        w = w[1:]
    w = re.sub("^X", "S", w)
    w = re.sub("^WH", "W", w)
    code, i, n = [], 0, len(w)
    at = lambda k: w[k] if 0 <= k < n else ""
    vowel, front = set("AEIOU"), set("EIY")
    while i < n:
        c, before, after = w[i], at(i - 1), at(i + 1)
        step, out = 1, ""
        if c == before and c != "C":
            pass
        elif c in vowel:
            out = c if i == 0 else ""
        elif c == "B":
            out = "" if before == "M" and i == n - 1 else "B"
        elif c == "C":
            if w[i : i + 3] == "CIA" or after == "H":
                out = "K" if after == "H" and before == "S" else "X"
                step = 2 if after == "H" else 1
            elif after in front and after:
                out = "" if before == "S" else "S"
            else:
                out = "K"
        elif c == "D":
            out = "J" if after == "G" and at(i + 2) in front and at(i + 2) else "T"
        elif c == "G":
            if after == "H" and not (i + 2 < n and at(i + 2) in vowel):
                out = ""
            elif after == "N" and (i + 2 == n or w[i + 1 :] == "NED"):
                out = ""
            elif after in front and after and before != "G":
                out = "" if before == "D" else "J"
            else:
                out = "K"
        elif c == "H":
            out = "H" if after in vowel and before not in set("CSPTG") else ""
        elif c == "K":
            out = "" if before == "C" else "K"
        elif c == "P":
            out, step = ("F", 2) if after == "H" else ("P", 1)
        elif c == "Q":
            out = "K"
        elif c == "S":
            if after == "H":
                out, step = "X", 2
            else:
                out = "X" if w[i : i + 3] in ("SIO", "SIA") else "S"
        elif c == "T":
            if w[i : i + 3] in ("TIA", "TIO"):
                out = "X"
            elif after == "H":
                out, step = "0", 2
            else:
                out = "" if w[i : i + 3] == "TCH" else "T"
        elif c == "V":
            out = "F"
        elif c in "WY":
            out = c if after in vowel else ""
        elif c == "X":
            out = "KS"
        elif c == "Z":
            out = "S"
        else:
            out = c
        code.append(out)
        i += step
    return "".join(code)
