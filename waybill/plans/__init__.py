"""The domain layers, each a set of DataFrame -> DataFrame functions."""
