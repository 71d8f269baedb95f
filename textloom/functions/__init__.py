from textloom.functions.cleaning import (
    clean_text, normalise_text, remove_stop_words, stop_words, tokenise, with_tokens,
)
from textloom.functions.keys import choose, order_key
from textloom.functions.terms import feature_tokens, ngrams, term_counts, word_count

__all__ = [
    "choose", "clean_text", "feature_tokens", "ngrams", "normalise_text", "order_key",
    "remove_stop_words", "stop_words", "term_counts", "tokenise", "with_tokens", "word_count",
]
