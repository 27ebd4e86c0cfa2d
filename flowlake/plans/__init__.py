"""Named queries (operator + arguments + oracle SQL) over the fixture tables."""
