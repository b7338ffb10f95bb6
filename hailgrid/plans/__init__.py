"""Named queries over the star tables, and the jobs that build those tables."""
