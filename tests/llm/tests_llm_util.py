"""Helpers of these tests."""

#: Names that the operators use inside; a table may have them too.
CLASHES = ("k1", "k2", "rid", "digest", "kept", "size", "row", "epoch", "cut", "label", "key", "block", "l", "place", "n", "h", "_keep", "two words", "a:b")


def words(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]
