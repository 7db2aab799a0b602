"""Reading corpora and annotations, writing results."""
