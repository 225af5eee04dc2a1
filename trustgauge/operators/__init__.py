"""DataFrame operators: features, sampling, models, calibration, evaluation."""
