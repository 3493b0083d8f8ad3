import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def sentence(rng, n, prefix="w"):
    return " ".join(f"{prefix}{rng.integers(0, 5000)}" for _ in range(n))
