from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string"


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def corpus(seed=1, n=40):
    """Texts of random words with copies, shared passages and lines, odd rows, and one very long text."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeéü", k=rng.randint(2, 7))) for _ in range(300)]
    sentence = lambda k: " ".join(rng.choices(vocabulary, k=k)).capitalize() + "."
    shared = [sentence(25) for _ in range(3)]
    rows = []
    for k in range(n):
        lines = [sentence(rng.randint(3, 30)) for _ in range(rng.randint(1, 5))]
        if rng.random() < 0.4:
            lines.insert(rng.randint(0, len(lines)), rng.choice(shared))
        rows.append((k, "\n".join(lines)))
    rows += [(n + k, rows[k][1]) for k in range(4)]
    rows += [(n + 10 + k, rows[k][1].replace(rows[k][1].split(" ")[2], "zzz", 1)) for k in range(6)]
    rows += [(n + 20, None), (n + 21, ""), (n + 22, "\n"), (n + 23, "!!! ..."), (n + 24, "a"), (None, rows[1][1]), (5, rows[5][1]), (n + 25, "ab" * 200), (n + 26, " ".join(rng.choices(vocabulary, k=4000)))]
    return rows
