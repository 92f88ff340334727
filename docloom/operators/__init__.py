"""Relational operators: pairing, consensus, the resolution ladder, evaluation, calibration and the rest."""
