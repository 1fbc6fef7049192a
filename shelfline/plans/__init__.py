"""Star-schema build and the decision-support query catalogue."""
