"""Texts that a polynomial hash modulo a power of two cannot tell apart."""


def thue_morse(n: int, zero: str, one: str) -> tuple[list[str], list[str]]:
    """The first ``n`` symbols of the Thue-Morse sequence, and of its complement."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return [one if b else zero for b in bits], [zero if b else one for b in bits]
