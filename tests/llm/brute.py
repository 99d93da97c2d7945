"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text: str | None) -> list[str]:
    return WORD.findall(text or "")


def statistics(text: str | None) -> dict:
    w, t = words(text), text or ""
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = Counter(windows)
    repeated = {i + k for i, x in enumerate(windows) if often[x] > 1 for k in range(8)}
    lines = [x for x in t.split("\n") if words(x)]
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in t),
        "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(repeated),
        "base_failed": len(w) < 20 or 100 * len(repeated) > 30 * len(w),
    }


def phrase_places(text: str | None) -> tuple[int, list[tuple[int, str]]]:
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    found = [
        (i, label) for p, label in phrases.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()
    ]
    return len(w), found
