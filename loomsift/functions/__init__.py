"""loomsift.functions"""
