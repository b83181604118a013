"""Fixed values of the Jaro-Winkler measure and what they imply for a threshold."""

PREFIX_WEIGHT = 0.1
PREFIX_LENGTH = 4
BOOST_ABOVE = 0.7
LETTER_CLASSES = 21  # of letters, three bits each
SLACK = 1e-9


def needed(threshold: float, prefix: int) -> float:
    """How much m/|a| + m/|b| two strings with this shared start need to reach ``threshold``.

    The similarity reaches t only if the Jaro part reaches (t - 0.1p) / (1 - 0.1p), and that is at
    most (m/|a| + m/|b| + 1) / 3 for m matching characters.
    """
    boosted = (threshold - PREFIX_WEIGHT * prefix) / (1 - PREFIX_WEIGHT * prefix)
    return 3 * (min(threshold, max(BOOST_ABOVE, boosted)) - SLACK) - 1
