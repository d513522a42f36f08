"""Texts of made-up words."""


def words(rng, count, letters="abcdefg"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(count))
