"""Token counts for large vocabularies and for pre-tokens that need many states."""

import json
import random

import public_tokenizers as P
from tokenizers import Tokenizer

from scorewright.llm import queries as Q
from scorewright.llm import token_count


def test_vocabulary_beyond_16_bits(tmp_path):
    with open(P.path(Q.COUNT_VOCABULARY), encoding="utf-8") as f:
        spec = json.load(f)
    vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
    special = {t["content"] for t in spec["added_tokens"]}
    draw, plain = random.Random(5), [t for t in vocab if t not in special and len(t) < 12]
    letters = [t for t in plain if t.isascii() and t.isalpha()]
    number = max([*vocab.values(), *(t["id"] for t in spec["added_tokens"])]) + 1
    added = []
    while len(vocab) < 70_000:
        a, b = draw.choice(letters), draw.choice(letters)
        if a + b not in vocab:
            vocab[a + b] = number
            number += 1
            merges.append([a, b] if isinstance(merges[0], list) else f"{a} {b}")
            added.append(a + b)
    path = str(tmp_path / "large.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(spec, f)
    texts = ["".join(draw.choice([" ", "", "-"]) + draw.choice(added) + draw.choice(["", draw.choice(letters)]) for _ in range(draw.randint(1, 30))) for _ in range(300)]
    library = Tokenizer.from_file(path)
    want = [len(library.encode(x, add_special_tokens=False).ids) for x in texts]
    assert token_count.Transducer(path).counts(texts).tolist() == want


def test_states_stay_bounded_inside_a_pretoken(monkeypatch):
    draw = random.Random(7)
    text = "".join(draw.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(20_000))
    want = len(Tokenizer.from_file(P.path(Q.COUNT_VOCABULARY)).encode(text, add_special_tokens=False).ids)
    monkeypatch.setattr(token_count, "MAX_STATES", 50)
    t = token_count.Transducer(P.path(Q.COUNT_VOCABULARY))
    assert t.counts([text]).tolist() == [want] and len(t.states) <= 52
