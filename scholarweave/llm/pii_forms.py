"""Training examples for spellings of personal data that the fixed patterns do not cover.

A corpus may hold few or none of a form, so the trees of ``pii`` would have nothing to learn it from.
``examples`` writes texts by rule: a form of personal data, or something that only looks like one, between
plain words, in half of the cases after a cue word.  They are the same for every corpus.
"""

from __future__ import annotations

import random

# Words around an example.
WORDS = ("the", "and", "report", "of", "we", "in", "value", "for", "see", "was", "with", "on", "from", "data", "is")
CUES = {"email": ("mail", "contact", "e-mail"), "ip": ("host", "server", "ip"),
        "card": ("card", "visa", "credit"), "phone": ("tel", "phone", "call", "fax")}
NAMES = ("joe", "anna.b", "info", "k_lee", "office-2", "maria", "t.huber", "sales", "x1", "jane99")
HOSTS = ("host", "mail.example", "uni-ulm", "lab", "dept.big", "site7", "my-firm", "zbw", "cs.college")
ENDS = ("org", "com", "de", "net", "edu", "info", "uk")


def _digits(r: random.Random, n: int, first: str = "123456789") -> str:
    return r.choice(first) + "".join(r.choice("0123456789") for _ in range(n - 1))


def _with_check_digit(body: str, wrong: int = 0) -> str:
    """``body`` and its Luhn digit, or with ``wrong`` (1 to 9) another digit."""
    total = sum(sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(reversed(body)))
    return body + str((-total + wrong) % 10)


def _grouped(number: str, sizes: tuple[int, ...], by: str) -> str:
    out, at = [], 0
    for n in sizes:
        out.append(number[at:at + n])
        at += n
    return by.join(out)


def _email(r: random.Random, good: bool) -> str:
    left, right = r.choice("([{"), {"(": ")", "[": "]", "{": "}"}
    at = left + r.choice(("at", "At", "AT")) + right[left]
    gap = r.choice(("", " "))
    if not good:
        when = r.choice((f"{r.randint(1, 12)}.{r.randint(10, 59)}", f"{r.randint(1, 31)}.{r.randint(1, 12)}.{r.randint(1980, 2030)}",
                         f"{r.randint(0, 9)}.{r.randint(0, 99)}"))
        return r.choice((f"{r.choice(WORDS)}{gap}{at}{gap}{when}", f"{r.choice(NAMES)}@{r.choice(WORDS)}"))
    dot = r.choice((".", f"{gap}{left}{r.choice(('dot', 'Dot', 'DOT'))}{right[left]}{gap}"))
    host = r.choice(HOSTS).replace(".", dot) + dot + r.choice(ENDS)
    return f"{r.choice(NAMES)}{gap}{at}{gap}{host}"


def _ip(r: random.Random, good: bool) -> str:
    group = lambda: format(r.randint(1, 0xFFFF), "x")
    if good:
        head = r.choice(("2001", "fe80", "2a02", "fd00", "2606"))
        full = [head, *[group() for _ in range(7)]]
        short = f"{head}::{':'.join(group() for _ in range(r.randint(2, 4)))}"
        middle = f"{head}:{group()}:{group()}::{group()}"
        return r.choice((":".join(full), short, middle))
    return r.choice((f"{r.randint(0, 23)}:{r.randint(10, 59)}:{r.randint(10, 59)}", f"{r.randint(1, 9)}:{r.randint(1, 9)}:{r.randint(1, 9)}",
                     ":".join(format(r.randint(0, 255), "02x") for _ in range(6)), f"{group()[:2]}::{group()[:2]}",
                     f"{r.randint(256, 999)}.{r.randint(0, 99)}.{r.randint(0, 99)}.{r.randint(0, 99)}"))


def _card(r: random.Random, good: bool) -> str:
    wrong = 0 if good else r.randint(1, 9)
    if not good and r.random() < 0.2:
        return " ".join(_with_check_digit(_digits(r, 15)) for _ in range(2))       # two numbers in a row
    if r.random() < 0.3:
        return _grouped(_with_check_digit("3" + r.choice("47") + _digits(r, 12), wrong), (4, 6, 5), r.choice(" -."))
    number = _with_check_digit(r.choice("4562") + _digits(r, 14), wrong)
    return _grouped(number, (4, 4, 4, 4), r.choice((".", "/", "  ", "_", "- ")) if good else r.choice((".", "/", " ", "-", "")))


def _phone(r: random.Random, good: bool) -> str:
    d = lambda n: _digits(r, n)
    if good:
        area = "0" + d(r.randint(2, 4))
        return r.choice((f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{area} {d(r.randint(6, 8))}", f"({area}) {d(r.randint(6, 8))}",
                         f"{area}/{d(r.randint(6, 8))}", f"00{d(2)} {d(2)} {d(7)}", f"{d(3)}.{d(3)}.{d(4)}"))
    return r.choice((d(r.randint(7, 15)), "0" + d(r.randint(7, 12)), f"{r.randint(1900, 2030)}-{r.randint(10, 12)}-{r.randint(10, 28)}",
                     f"{r.randint(10, 28)}.{r.randint(10, 12)}.{r.randint(1900, 2030)}", f"{r.randint(1900, 2030)}-{r.randint(1900, 2030)}",
                     f"{r.randint(1900, 2030)} {r.randint(1900, 2030)}", f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"{d(1)} {d(3)} {d(3)}",
                     f"{d(2)} {d(3)} {d(3)}", f"{d(3)}.{d(5)}", f"{d(1)}.{d(7)}", f"{d(3)} {d(3)} {d(3)}", " ".join(d(2) for _ in range(5)),
                     f"{d(4)} {d(4)}", f"{d(5)}-{d(5)}", f"{d(2)}/{d(2)}/{d(4)}"))


_FORMS = {"email": _email, "ip": _ip, "card": _card, "phone": _phone}


def examples(n: int):
    """(text, kind, start, end, label): ``n`` of each kind and label."""
    r = random.Random(11)
    for _ in range(n):
        for kind, form in _FORMS.items():
            for label in (1, 0):
                before = [r.choice(WORDS) for _ in range(r.randint(0, 5))]
                if before and r.random() < 0.5:
                    before[-1] = r.choice(CUES[kind])
                head = " ".join(before) + (r.choice((" ", ": ")) if before else "")
                s = form(r, bool(label))
                tail = r.choice(("", ".", *(f"{by}{w}" for by in (" ", ". ", ", ") for w in WORDS)))
                yield f"{head}{s}{tail}", kind, len(head), len(head) + len(s), label
