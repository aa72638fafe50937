"""Named processors from the documentation, ready to use by name.

``upcaser`` upper-cases a line, ``tokenizer`` emits one record per word,
``identity`` passes a record through, ``from_json`` / ``to_json`` parse
and print JSON lines, and ``prime_factorizer`` emits the prime factors of
a number, one per record.  ``lookup`` registers them on first need.
"""

from lineflow.functions.steps import from_json, identity, to_json, tokenize, upcase
from lineflow.functions.udtf import factorize
from lineflow.operators.batch import python_step
from lineflow.plans.registry import _REGISTRY, register


def registered_names() -> set[str]:
    return set(_REGISTRY)


def prime_factor_lines(line: str) -> list[str]:
    return [str(p) for p in factorize(int(line.strip()))]


# Registered without replacing a user's flow of the same name.
for _name, _step in (
    ("identity", identity()),
    ("upcaser", upcase()),
    ("tokenizer", tokenize()),
    ("from_json", from_json()),
    ("to_json", to_json()),
    ("prime_factorizer", python_step(prime_factor_lines, "prime_factorizer")),
):
    if _name not in registered_names():
        register(_name, _step)
