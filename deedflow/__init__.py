"""deedflow."""
