"""The batch operators over file streams."""
