"""Training-data operators over text corpora (one module per operator).

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries when it is present."""
