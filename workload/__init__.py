"""The transactions fixture, and one query with its SQL twin per operator."""
