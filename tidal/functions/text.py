"""Text cleaning and tokenisation as built-in regex/array expressions.

Word characters are ``[\\p{L}\\p{N}_]`` (letters, numbers, underscore) in
every engine, so accented prose tokenises the same in Spark (Java regex)
and DuckDB (RE2); digits are ASCII ``[0-9]``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference (two cleaner variants).
IP_TOKEN = "IP_ADDR"
NUM_TOKEN = "NUM"
LSA_IP_TOKEN = "ip_address"
LSA_NUM_TOKEN = "num"

WORD = r"\p{L}\p{N}_"
IP_PATTERN = r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+"
WHOLE_NUMBER = rf"(?<![{WORD}])[0-9]+(?![{WORD}])"
NON_WORD_RUN = rf"[^{WORD}]+"


# The English stop words that Spark ML publishes, in its order.
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself
she her hers herself it its itself they them their theirs themselves what which who whom
this that these those am is are was were be been being have has had having do does did doing
a an the and but if or because as until while of at by for with about against between into
through during before after above below to from up down in out on off over under again
further then once here there when where why how all any both each few more most other some
such no nor not only own same so than too very s t can will just don should now i'll you'll
he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm you're he's she's it's we're
they're i've we've you've they've isn't aren't wasn't weren't haven't hasn't hadn't don't
doesn't didn't won't wouldn't shan't shouldn't mustn't can't couldn't cannot could here's
how's let's ought that's there's what's when's where's who's why's would
""".split()


def english_stop_words() -> tuple[str, ...]:
    """The stop-word list that the tokeniser and its SQL twins share."""
    return tuple(STOP_WORDS)


def clean_text(text, ip_token: str = IP_TOKEN, num_token: str = NUM_TOKEN) -> Column:
    """null -> ''; lower; dotted quad -> ip_token; whole-word digits ->
    num_token; every run of non-word characters -> one space; trim."""
    t = F.col(text) if isinstance(text, str) else text
    t = F.lower(F.coalesce(t, F.lit("")))
    t = F.regexp_replace(t, IP_PATTERN, ip_token)
    t = F.regexp_replace(t, WHOLE_NUMBER, num_token)
    t = F.regexp_replace(t, NON_WORD_RUN, " ")
    return F.trim(t)


def duck_clean_sql(col: str, ip_token: str = IP_TOKEN, num_token: str = NUM_TOKEN) -> str:
    """DuckDB twin of :func:`clean_text` (RE2 has no look-around, so the
    whole-number rule is applied per token after splitting)."""
    base = (f"trim(regexp_replace(regexp_replace(lower(coalesce({col}, '')), "
            f"'{IP_PATTERN}', '{ip_token}', 'g'), '{NON_WORD_RUN}', ' ', 'g'))")
    return (f"array_to_string(list_transform(string_split({base}, ' '), "
            f"lambda x: CASE WHEN regexp_full_match(x, '[0-9]+') THEN '{num_token}' ELSE x END), ' ')")
