"""Feature vectors, tree classifiers, evaluation and batch scoring on MLlib."""
