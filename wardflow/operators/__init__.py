"""Building blocks shared by the models and the checks."""
