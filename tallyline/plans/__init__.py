"""From raw transactions to clean sales to business tables."""
