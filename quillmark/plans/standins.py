"""Deterministic stand-ins for models, for tests and for queries checked against SQL.

Each factory returns a function from inputs to results, as a real model would.
"""

from __future__ import annotations


def parrot():
    """A model that answers with the whole user turn of its prompt, every second time without its first half."""
    from hashlib import md5

    def answer(prompt):
        said = prompt.split("<start_of_turn>user\n", 1)[1].split("<end_of_turn>", 1)[0].strip()
        return said if md5(said.encode()).hexdigest() < "8" else said[len(said) // 2 :].strip()

    return lambda prompts: [answer(p) for p in prompts]


def coin_verdict():
    """A judge that says Yes or No by the digest of its prompt."""
    from hashlib import md5

    def verdict(prompt):
        return "Yes" if md5(prompt.encode()).hexdigest() < "8" else "No, not quite"

    return lambda prompts: [verdict(p) for p in prompts]


def digest_text():
    """A writer whose text is the digest of its prompt."""
    from hashlib import md5

    return lambda prompts: [f" Because {md5(p.encode()).hexdigest()}\n" for p in prompts]


def moody_text():
    """The same writer, which fails on a quarter of its prompts by their digests."""
    from hashlib import md5

    def write(prompt):
        digest = md5(prompt.encode()).hexdigest()
        if digest < "4":
            raise ValueError("no answer")
        return f" Because {digest}\n"

    return lambda prompts: [write(p) for p in prompts]


def flaky_text():
    """The same writer, of whose prompts a quarter fails twice before it answers, some always for a passing reason, some for good."""
    from hashlib import md5

    failures: dict = {}

    def write(prompt):
        digest = md5(prompt.encode()).hexdigest()
        if digest >= "f":
            raise ValueError("not to be answered")
        if digest >= "e" or (digest < "4" and failures.get(digest, 0) < 2):
            failures[digest] = failures.get(digest, 0) + 1
            raise ConnectionError("try again")
        failures.pop(digest, None)
        return f" Because {digest}\n"

    return lambda prompts: [write(p) for p in prompts]


def short_pieces():
    """A tokenizer of runs of at most four small letters and of single other characters."""
    import re

    pieces = re.compile("[a-z]{1,4}|[^a-z]")
    return lambda texts: [[m.end() for m in pieces.finditer(t)] for t in texts]


def letter_counts():
    """An embedder that counts eight letters."""
    return lambda texts: [[float(t.count(c)) for c in "aeionrst"] for t in texts]


def word_logprobs():
    """A scorer of (prompt, answer) with two tokens for each answer word, at a tenth and a fifth of its length below 0."""

    def score(prompt, answer):
        return [-len(w) / part for w in answer.split(" ") for part in (10, 5)]

    return lambda pairs: [score(p, a) for p, a in pairs]


def replay():
    """A model that repeats a recorded reply: inputs are (prompt, reply)."""

    def reply(prompt, recorded):
        if not prompt:
            raise ValueError("empty prompt")
        return recorded

    return lambda pairs: [reply(p, r) for p, r in pairs]


def pair_writer():
    """Up to 25 pairs that together hold the whole chunk, as fenced JSON; every eighth reply has none."""
    import json
    from hashlib import md5

    def write(prompt):
        text = prompt.split("Text:\n", 1)[1][:-1]
        if md5(text.encode()).hexdigest() < "2":
            return "Sorry, I cannot do that."
        size = max(1, -(-len(text) // 25))
        pieces = [text[i : i + size] for i in range(0, len(text), size)]
        pairs = [{"question": f"{i}: {p}?", "answer": p[::2] if i % 2 else "Not specified"} for i, p in enumerate(pieces)]
        return "Sure:\n```json\n" + json.dumps(pairs, ensure_ascii=False) + "\n```"

    return lambda prompts: [write(p) for p in prompts]


def _pairs_of(prompt):
    import json

    text = prompt.split("Text:\n", 1)[1][:-1]
    size = max(1, -(-len(text) // 25))
    pieces = [text[i : i + size] for i in range(0, len(text), size)]
    pairs = [{"question": f"{i}: {p}?", "answer": p[::2] if i % 2 else "Not specified"} for i, p in enumerate(pieces)]
    return text, [json.dumps(p, ensure_ascii=False) for p in pairs]


def cut_off_writer():
    """The same pairs, but the reply ends within a pair: its digest says how many are complete.

    Every sixteenth prompt fails, every eighth has no pairs.
    """
    from hashlib import md5

    def write(prompt):
        text, pairs = _pairs_of(prompt)
        digest = md5(text.encode()).hexdigest()
        if digest >= "f":
            raise RuntimeError("no reply")
        if digest < "2":
            return "Sorry, I cannot do that."
        whole = int(digest[1:3], 16) % (len(pairs) + 1)
        if whole == len(pairs):
            return "[" + ", ".join(pairs) + "]"
        return "Sure: [" + ", ".join([*pairs[:whole], pairs[whole][: len(pairs[whole]) // 2]])

    return lambda prompts: [write(p) for p in prompts]


def moody_rater():
    """``pair_rater``, which also fails on some prompts."""
    import json
    from hashlib import md5

    rater = pair_rater()

    def reply(prompt):
        first = json.loads(prompt.split("just return valid JSON:\n\n", 1)[1])[0]["question"]
        if md5(first.encode()).hexdigest()[1] == "3":
            raise RuntimeError("no rating")
        return rater([prompt])[0]

    return lambda prompts: [reply(p) for p in prompts]


def moody_parrot():
    """``parrot``, which fails on some prompts."""
    from hashlib import md5

    model = parrot()

    def answer(prompt):
        if md5(prompt.encode()).hexdigest() >= "d":
            raise RuntimeError("no answer")
        return model([prompt])[0]

    return lambda prompts: [answer(p) for p in prompts]


def moody_verdict():
    """``coin_verdict``, which fails on some prompts."""
    from hashlib import md5

    model = coin_verdict()

    def verdict(prompt):
        if md5(prompt.encode()).hexdigest()[1] == "0":
            raise RuntimeError("no verdict")
        return model([prompt])[0]

    return lambda prompts: [verdict(p) for p in prompts]


def pair_rater():
    """A rating from 1 to 10 by the digest of the question, quoted or not.

    By the digest of the first question some replies are unreadable, lack the first pair, or
    have one more.
    """
    import json
    from hashlib import md5

    def rate(pair):
        value = int(md5(pair["question"].encode()).hexdigest()[0], 16) % 10 + 1
        return {**pair, "rating": str(value) if value % 2 else value}

    def reply(prompt):
        pairs = json.loads(prompt.split("just return valid JSON:\n\n", 1)[1])
        mood = md5(pairs[0]["question"].encode()).hexdigest()[1]
        if mood == "0":
            return "I would rate them all highly."
        rated = [rate(p) for p in pairs]
        if mood == "1":
            rated = rated[1:]
        if mood == "2":
            rated.insert(0, {"question": "What else?", "answer": "Nothing", "rating": 10})
        return json.dumps(rated, ensure_ascii=False)

    return lambda prompts: [reply(p) for p in prompts]
