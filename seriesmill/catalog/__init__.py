"""Named queries over the sample tables and their SQL counterparts."""
