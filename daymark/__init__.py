"""Analytics on tables that arrive as daily snapshots."""
