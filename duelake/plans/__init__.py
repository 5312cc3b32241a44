"""Named bronze, silver and gold outputs, and the jobs that publish them."""
