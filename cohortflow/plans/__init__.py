"""Stages composed of operators, and the tree form explanations work on."""
