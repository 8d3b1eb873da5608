"""Text clean-up as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_column

# The 32 ASCII punctuation marks.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Tag pattern (a dot stops at a line feed only) and the characters of words.
TAG = "(?d)<.*?>"
WORD = r"[\p{L}\p{N}_]"

# Contractions and their expansions.
CONTRACTIONS = {
    "ain't": "are not", "aren't": "are not", "can't": "cannot", "could've": "could have",
    "couldn't": "could not", "didn't": "did not", "doesn't": "does not", "don't": "do not",
    "hadn't": "had not", "hasn't": "has not", "haven't": "have not", "he'd": "he would",
    "he'll": "he will", "he's": "he is", "here's": "here is", "how'd": "how did", "how's": "how is",
    "i'd": "i would", "i'll": "i will", "i'm": "i am", "i've": "i have", "isn't": "is not",
    "it'd": "it would", "it'll": "it will", "it's": "it is", "let's": "let us",
    "mightn't": "might not", "might've": "might have", "mustn't": "must not",
    "must've": "must have", "needn't": "need not", "shan't": "shall not", "she'd": "she would",
    "she'll": "she will", "she's": "she is", "should've": "should have",
    "shouldn't": "should not", "that'd": "that would", "that'll": "that will",
    "that's": "that is", "there'd": "there would", "there's": "there is", "they'd": "they would",
    "they'll": "they will", "they're": "they are", "they've": "they have", "wasn't": "was not",
    "we'd": "we would", "we'll": "we will", "we're": "we are", "we've": "we have",
    "weren't": "were not", "what'll": "what will", "what're": "what are", "what's": "what is",
    "what've": "what have", "where's": "where is", "who'll": "who will", "who's": "who is",
    "who've": "who have", "why's": "why is", "won't": "will not", "would've": "would have",
    "wouldn't": "would not", "y'all": "you all", "you'd": "you would", "you'll": "you will",
    "you're": "you are", "you've": "you have",
}

# Words that only look like a contraction without its apostrophe.
ORDINARY_WORDS = (
    "cant", "hell", "hed", "ill", "id", "its", "lets", "shed", "shell", "wed", "well", "were",
    "whore", "wont",
)


def contraction_words() -> dict[str, str]:
    """The contractions and, unless they are words of their own, the forms without apostrophe."""
    bare = {word.replace("'", ""): full for word, full in CONTRACTIONS.items()}
    return CONTRACTIONS | {word: full for word, full in bare.items() if word not in ORDINARY_WORDS}


def strip_tags(text: Column | str) -> Column:
    return F.regexp_replace(as_column(text), F.lit(TAG), F.lit(""))


def strip_punctuation(text: Column | str) -> Column:
    return F.translate(as_column(text), PUNCTUATION, "")


def _one_of(words) -> str:
    """A pattern for any of the words, longest first, that shares their beginnings; either apostrophe."""
    tree: dict = {}
    for word in words:
        node = tree
        for c in word:
            node = node.setdefault(c, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        parts = [("['\u2019]" if c == "'" else c) + pattern(below) for c, below in sorted(node.items()) if c]
        if not parts:
            return ""
        return (parts[0] if len(parts) == 1 and "" not in node else "(?:" + "|".join(parts) + ")") + "?" * ("" in node)

    return pattern(tree)


def contraction_pattern() -> str:
    """A contraction that is a whole word: no letter, digit, low line or inner apostrophe goes on beside it.

    Most places fail on their first character, so texts are scanned once at little cost.
    """
    words = contraction_words()
    first = "".join(sorted({w[0] for w in words}))
    return (
        rf"(?i)(?=[{first}])(?<!{WORD})(?<!{WORD}['\u2019]){_one_of(words)}(?!{WORD})(?!['\u2019]{WORD})"
    )


def expand_contractions(text: Column | str) -> Column:
    """Replace contractions that are whole words; all that stands between words is kept as it is.

    Straight and curly apostrophes count alike. A capital first letter stays, and a contraction in
    capitals is expanded in capitals. Texts without any of the words are passed through.
    """
    words, text = contraction_words(), as_column(text)
    lookup = F.create_map(*[F.lit(v) for pair in words.items() for v in pair])
    some = F.lit(contraction_pattern())

    def expanded(word: Column) -> Column:
        full = F.element_at(lookup, F.lower(F.translate(word, "\u2019", "'")))
        first = F.substring(word, 1, 1)
        return (
            F.when((F.length(word) > 1) & (word == F.upper(word)), F.upper(full))
            .when(first == F.upper(first), F.concat(F.upper(F.substring(full, 1, 1)), F.substring(full, 2, 1_000)))
            .otherwise(full)
        )

    found = F.transform(F.regexp_extract_all(text, some, F.lit(0)), expanded)
    # What stands between the words is one piece more than the words.
    joined = F.zip_with(F.split(text, contraction_pattern(), -1), found, lambda piece, word: F.concat(piece, F.coalesce(word, F.lit(""))))
    return F.when(F.regexp_like(text, some), F.array_join(joined, "")).otherwise(text)


def clean_text(text: Column | str, remove_html_tags: bool = True, lowercase_text: bool = True,
               remove_punctuation: bool = True, expand: bool = True) -> Column:
    """The steps in this order: tags, case, punctuation, contractions."""
    text = as_column(text)
    if remove_html_tags:
        text = strip_tags(text)
    if lowercase_text:
        text = F.lower(text)
    if remove_punctuation:
        text = strip_punctuation(text)
    if expand:
        text = expand_contractions(text)
    return text
