"""DataFrame operators: terms, index, ranking, evaluation, preparation, models."""
