"""Inputs, reports and registered queries made of the operators."""
