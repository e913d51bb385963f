"""Words of the invented languages, for tests that build texts of their own."""

LANGUAGES = {
    "en": "the of and to in is that it was for on are with as his they at be this from",
    "fr": "le de un être et à il avoir ne je son que se qui ce dans en du elle au",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
}


def prose(rng, lang, n):
    return " ".join(rng.choice(LANGUAGES[lang].split()) for _ in range(n))
