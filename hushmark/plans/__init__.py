"""Plan shapes and derived inputs shared by several operators."""
