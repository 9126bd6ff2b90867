"""DataFrame operators, estimators and fitted models."""
