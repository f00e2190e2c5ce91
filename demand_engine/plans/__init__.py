"""The three jobs: prepare the data, train a model, report."""
