"""Part of claimlake."""
