"""DataFrame operators: relational, vocabulary, lexicon, similarity, answers."""
