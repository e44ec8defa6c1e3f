"""Message streams into lake tables."""
