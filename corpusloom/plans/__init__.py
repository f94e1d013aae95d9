"""The operators put together: corpus preparation and scoring from start to end."""
