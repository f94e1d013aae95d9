"""DataFrame operators: a DataFrame in, a DataFrame out, so that they chain with ``transform``."""
