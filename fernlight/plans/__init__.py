"""Named queries over the driver tables, and the analyze and collect runs."""
