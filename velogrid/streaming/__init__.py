"""Live versions of the departure and arrival counts."""
