"""Texts for the operator tests."""

WORDS = "amber birch cedar delta ember fjord grove haven inlet jetty knoll ledge marsh north ocean prairie quarry ridge".split()


def prose(seed: int, n: int) -> str:
    return " ".join(WORDS[(seed * 7 + k * k + k * seed) % len(WORDS)] + str((seed * 31 + k) % 97) for k in range(n))
