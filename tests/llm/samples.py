"""Texts for the tests, made by a seed."""

import random

LONG = 60_000


def sentence(random_: random.Random, words: int) -> str:
    syllables = "the of and ing er tion la de que en ß é ü ñ".split()
    out = ["".join(random_.choice(syllables) for _ in range(random_.randint(1, 4))) for _ in range(words)]
    return " ".join(out).capitalize() + "."


def text(random_: random.Random, lines: int) -> str:
    return "\n".join(sentence(random_, random_.randint(3, 30)) for _ in range(lines))


def corpus(seed: int = 1, n: int = 60) -> list[tuple]:
    """Rows (doc_id, text, lang, source): copies, near copies, shared passages, odd texts."""
    r = random.Random(seed)
    base = [text(r, r.randint(1, 12)) for _ in range(n // 2)]
    passage = sentence(r, 40)
    shared = text(r, 6)
    rows = []
    for i in range(n):
        kind = i % 6
        t = base[i % len(base)]
        if kind == 1:
            words = t.split(" ")
            words[len(words) // 2] = "changed"
            t = " ".join(words)
        elif kind == 2:
            t = f"{t}\n{passage} {sentence(r, 5)}"
        elif kind == 3:
            t = f"{sentence(r, 4)}\n{shared}\n{sentence(r, 9)}"
        rows.append((10 * i + 3, t, ["en", "de", None][i % 3], ["src0", "src1", None, "a.b.co.uk"][i % 4]))
    odd = ["", None, " \n\t ", "\n\n\n", "word", "<|endoftext|> a<|endoftext|>", "\x1c\x85 a b", "näive é İ ΣΑΣ", "日本語 テキスト 😀 " * 30, "a" * LONG, "x y " * (LONG // 4)]
    rows += [(5000 + i, t, "en", "src0") for i, t in enumerate(odd)]
    rows += [rows[0], (rows[1][0], "another text under the same id " * 5, "en", "src1"), (None, base[0], None, None)]
    return rows
