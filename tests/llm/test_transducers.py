"""The composed transducer against its parts in a row, and against the grammar's rules word by word."""

from itertools import product

from hypothesis import given, settings
from hypothesis import strategies as st

from cladeworks.llm import toxicity

INSULTS = {"idiot": 4.0, "kill": 1.5}  # kill is in the list of threats too
WORDS = ["idiot", "kill", "hurt", "you", "not", "isn't", "said", "tree", ".", "\n", '"']


def in_a_row(symbols):
    """What the transducers write, each reading all of what the one before wrote."""
    line, weights = [toxicity.ALPHABET[x] for x in symbols], [1.0] * len(symbols)
    for t in toxicity.CASCADE:
        state, written = t.start, []
        for k, x in enumerate(line):
            state, y, w = t.step(state, x)
            written.append(y)
            weights[k] *= w
        line = written
    return list(zip(line, weights, strict=True))


def test_composition_is_the_cascade_on_every_short_path():
    arcs = toxicity._ARCS
    few = [*(1 << k for k in range(5)), 0, 3, 20, 32, 33, 34]
    for symbols in [*product(range(len(toxicity.ALPHABET)), repeat=2), *product(few, repeat=4)]:
        state, written = 0, []
        for x in symbols:
            state, y, w = arcs[state][x]
            written.append((y, w))
        assert written == in_a_row(symbols)


def by_rules(words):
    """The weights of each clause, each word judged by looking back from it."""
    found, start = [], 0
    for end, mark in enumerate([*words, "."]):
        if mark not in list(".\n"):
            continue
        own = [k for k in range(start, end) if words[k] != '"']
        aimed = any(words[k] == "you" for k in own)
        got = {}
        for at, k in enumerate(own):
            line = max((j + 1 for j in range(k) if words[j] == "\n"), default=0)
            quoted = words[line:k].count('"') % 2 == 1
            reported = quoted or any(words[j] == "said" for j in own[:at])
            negated = any(words[j] in ("not", "isn't") for j in own[max(0, at - toxicity.REACH) : at])
            if words[k] in INSULTS:
                context = "reported" if reported else "negated" if negated else "aimed" if aimed else "plain"
                got[context] = got.get(context, 0.0) + INSULTS[words[k]]
            elif words[k] == "hurt" and not (reported or negated):
                got["threat"] = got.get("threat", 0.0) + (toxicity.AIMED_THREAT if aimed else 1.0)
        if got:
            found.append(got)
        start = end + 1
    return found


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(WORDS), max_size=24))
def test_clauses_follow_the_rules(words):
    assert list(toxicity.clauses(words, INSULTS)) == by_rules(words)


def test_no_words_no_clauses():
    assert list(toxicity.clauses([], INSULTS)) == [] == list(toxicity.clauses(["tree"], {}))
