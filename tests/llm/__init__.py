"""Tests of the training-data operators; a package, so that its files may be named like those beside it."""
